"""Main text of generated pages against the article they were made from, and trees that are odd."""

import html as entities
import random
import re
import time

from cartoloom.llm import html
from cartoloom.llm.common import Staging


def article(source):
    inner = source[source.index("<article>") + 9 : source.index("</article>")]
    parts = re.split(r"</?(?:p|h1)>", inner)
    texts = [re.sub(r"\s+", " ", entities.unescape(re.sub(r"<[^>]*>", " " , re.sub(r"</?b>", "", p)))).strip() for p in parts]
    return "\n".join(t for t in texts if t)


def test_generated_pages(spark):
    sf = "/root/testdata/sf0.01"
    want = {r.page_id: article(r.html) for r in spark.read.parquet(f"{sf}/pages.parquet").collect()}
    got = html.op10_main_text(spark, sf).collect()
    assert {r.page_id: r.text for r in got} == want
    assert all(r.n_chars == len(r.text) for r in got)


def pages_of(spark, rows):
    return spark.createDataFrame([(i, u, h, "x", 1) for i, u, h in rows], "page_id long, url string, html string, host string, number int")


def test_template_without_names(spark):
    words = "amber birch cedar delta ember flint grove heath".split()
    rows = []
    for i in range(8):
        body = "".join(f"<p>{words[i]} {words[j]} text number {i} {j} goes on &amp; on</p>" for j in range(2 + i % 3))
        rows.append((i, f"http://host.example/{i}", f"<html><body><div><p>Welcome to the site, all rights kept</p></div><div><div><h2>{words[i]}</h2>{body}</div><div><p>Read this first: the same on every page</p></div></div></body></html>"))
    got = {r.page_id: r.text for r in html.main_text(pages_of(spark, rows), Staging(spark, "t")).collect()}
    for i in range(8):
        assert got[i] == "\n".join([words[i], *(f"{words[i]} {words[j]} text number {i} {j} goes on & on" for j in range(2 + i % 3))])


def test_odd_pages(spark):
    rows = [
        (1, "http://a.example/", None), (2, "http://a.example/2", ""), (3, None, "<article><p>one<p>two <b>b</article>"), (4, "nonsense", "plain &lt;text&gt;\n here"),
        (5, "http://b.example", "<p>cut <a href='x"), (6, "http://c.example", "<div>" * 3000 + "deep" + "</div>" * 3000), (7, "http://d.example", "<article>" + "<p>w</p>" * 5000 + "</article>"),
        (8, "http://e.example", "<body><article><h1>T</h1><p>x</p><div class='comments'><p>no</p></div><aside>no</aside></article><p>out</p></body>"), (8, "http://e.example", None),
    ]
    got = {r.page_id: r.text for r in html.main_text(pages_of(spark, rows), Staging(spark, "t")).collect()}
    assert got[1] == got[2] == "" and got[3] == "one\ntwo b" and got[4] == "plain <text> here"
    assert got[6] == "deep" and got[7] == "\n".join("w" * 5000) and got[8] == "T\nx" and "cut" in got[5]
    assert html.main_text(pages_of(spark, rows).limit(0), Staging(spark, "t")).count() == 0


def plain_common(x, y):
    best = [[0] * (len(y) + 1) for _ in range(len(x) + 1)]
    for i, p in enumerate(x):
        for j, q in enumerate(y):
            best[i + 1][j + 1] = best[i][j] + 1 if p == q else max(best[i][j + 1], best[i + 1][j])
    return best[-1][-1]


def test_common_subsequences(monkeypatch):
    rng = random.Random(1)
    for rows in (512, 4):
        monkeypatch.setattr(html, "ROWS", rows)
        for _ in range(300):
            x, y = ([rng.choice("abc") for _ in range(rng.randrange(25))] for _ in "xy")
            got = html.common(x, y)
            assert len(got) == plain_common(x, y)
            assert all(x[i] == y[j] for i, j in got) and all(a[0] < b[0] and a[1] < b[1] for a, b in zip(got, got[1:]))


def test_tree_matching():
    a, b = (html.parse(x) for x in ("<div><ul><li>1</li></ul><section><p>x</p></section></div>", "<div><section><p>y</p><p>z</p></section></div>"))
    assert [(x.tag, y.tag) for x, y in html.aligned(a, b)] == [("#", "#"), ("div", "div"), ("section", "section"), ("p", "p")]
    a, b = (html.parse(x) for x in ("<div class='x'>1</div><div class='post-7'>2</div>", "<div class='post-9'>3</div>"))
    assert [(x.mark, y.mark) for x, y in html.aligned(a, b)] == [("", ""), ("div.post-", "div.post-")]


def test_deep_and_wide_pages():
    began = time.time()
    deep = "<div>" * 5000 + "<p>one</p><p>two</p>" + "</div>" * 5000
    assert html.extract(deep, None, 0, set()) == "one\ntwo"
    rng = random.Random(2)
    wide = ["".join(f"<{t}>{i}</{t}>" for i, t in enumerate(rng.choices(["div", "p", "section", "h2"], k=20_000))) for _ in "ab"]
    model = html.parse(wide[0])
    html.numbered(model)
    assert len(html.evidence(model, html.parse(wide[1]))) > 10_000
    assert time.time() - began < 30


def test_names_inside_and_outside_of_articles():
    read = lambda body: html.extract(f"<html><body>{body}</body></html>", None, 0, set())
    assert read("<header>Site name</header><p>Article text</p>") == "Article text"
    assert read("<article><header><h1>Title</h1></header><p>x</p></article>") == "Title\nx"
    assert read("<article><div class='entry-header'><h1>Title</h1></div><p class='related'>a</p><section id='notice'><p>b</p></section></article>") == "Title\na\nb"
    assert read("<main><div class='ad'>buy</div><p>x</p><div class='comments box'><p>no</p></div></main>") == "x"
    assert read("<div class='side-effects'><p>a</p></div><div class='site-footer'>no</div><div id='cookie-box'>no</div><p>b</p>") == "a\nb"
    assert read("<div class='post-header'><h1>T</h1></div><div class='page-header'>no</div><p>b</p>") == "T\nb"


def test_hosts_beyond_the_bound_of_sending(spark, monkeypatch):
    rows = [(i, f"http://h{i % 3}.example/", f"<body><nav>menu</nav><article><p>text {i}</p></article></body>") for i in range(30)]
    want = {i: f"text {i}" for i in range(30)}
    assert {r.page_id: r.text for r in html.main_text(pages_of(spark, rows), Staging(spark, "t")).collect()} == want
    monkeypatch.setattr(html, "SENT_BYTES", 0)
    assert {r.page_id: r.text for r in html.main_text(pages_of(spark, rows), Staging(spark, "t")).collect()} == want


def test_title_and_lead_outside_the_body(spark):
    words = "amber birch cedar delta ember flint grove heath".split()
    rows = [
        (i, f"http://lead.example/{i}", f"<html><body><div><p>All rights kept by the site</p></div><div><h1>{w} title</h1><div><p>{w} lead</p></div><div><p>{f'{w} body ' * 20}</p></div></div></body></html>")
        for i, w in enumerate(words)
    ]
    got = {r.page_id: r.text for r in html.main_text(pages_of(spark, rows), Staging(spark, "t")).collect()}
    for i, w in enumerate(words):
        assert got[i] == "\n".join([f"{w} title", f"{w} lead", (f"{w} body " * 20).strip()])


def test_articles_side_by_side(spark):
    page = lambda i, n: "<body>" + "".join(f"<article><p>text {i} {j}</p></article>" for j in range(n)) + "</body>"
    rows = [(i, "http://many.example/", page(i, 1 + i % 3)) for i in range(9)] + [(99, "http://alone.example/", page(99, 3))]
    got = {r.page_id: r.text for r in html.main_text(pages_of(spark, rows), Staging(spark, "t")).collect()}
    for i in range(9):
        assert got[i] == "\n".join(f"text {i} {j}" for j in range(1 + i % 3))
    assert got[99] == "text 99 0\ntext 99 1\ntext 99 2"
