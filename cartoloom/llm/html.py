"""Main text of web pages by wrapper induction over the pages of a host."""

from __future__ import annotations

import html as entities
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Staging, table

# Element names as HTML defines them, and names that sites give to what is not the article.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript template iframe svg".split())
BLOCK = frozenset(
    "html body address article aside blockquote center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "header hgroup hr li main menu nav ol p pre search section summary table tbody td tfoot th thead tr ul".split()
)
CLOSES_P = BLOCK - frozenset("html body dd dt li summary tbody td tfoot th thead tr".split())
NOT_TEXT = frozenset("head script style noscript template iframe svg nav footer aside form button select textarea title input object canvas audio video menu dialog".split())
UNITS = frozenset("p h1 h2 h3 h4 h5 h6 li td th dt dd pre blockquote figcaption summary".split())
SLOTS = frozenset(("article", "main"))
#: Words in class names and ids of what is not the article. Outside article and main elements one of them may be any part
#: of a name but one that begins with a word of OWN; inside, only a class that is the whole word counts, and not on UNITS.
OTHER = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored sponsors promo promotion banner cookie cookies consent gdpr notice nav navbar navigation menu "
    "breadcrumb breadcrumbs sidebar widget widgets header masthead footer comment comments commentlist disqus replies respond share sharing social related "
    "newsletter subscribe popup modal toolbar skip pagination pager".split()
)
OWN = frozenset("entry post article content story main".split())
ROLES = frozenset("navigation banner contentinfo complementary search dialog alert menu menubar toolbar form".split())
#: A node of a host's template that so many pages share with the same text is part of the template, if at least
#: that many pages have been aligned.
CONSTANT_SHARE, CONSTANT_PAGES = 0.9, 5
#: Tables of hosts of no more bytes than this are sent to every task.
SENT_BYTES = 32 << 20
#: Rows of a table of common subsequences that are worked out again at once when its way is traced back.
ROWS = 512

_TOKEN = re.compile(r"<!--.*?(?:-->|$)|<!\[CDATA\[.*?(?:\]\]>|$)|<[!?][^>]*(?:>|$)|<(/?)([a-zA-Z][^\s/>]*)((?:\"[^\"]*\"|'[^']*'|[^'\">])*)(?:>|$)", re.S)
_ATTR = re.compile(r"(class|id|role|aria-hidden|hidden)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?(?=[\s/>]|$)", re.I)
_SPACE = re.compile(r"\s+")
_NUMBER = re.compile("[0-9]+")


@dataclass(slots=True)
class Node:
    """An element: its name, its name with its classes, whether it is in an article, and whether it is no part of one.

    kids: Nodes and strings, in order. size: length of its text without white space; digest tells equal texts.
    """

    tag: str
    mark: str = ""
    inside: bool = False
    other: bool = False
    kids: list = field(default_factory=list)
    number: int = -1
    size: int = 0
    digest: int = 0


def _names_other(name: str, value: str, tag: str, inside: bool) -> bool:
    words = value.split()
    if inside:
        return name == "class" and tag not in UNITS and not OTHER.isdisjoint(words)
    parts = (re.split("[-_]+", w) for w in words)
    return any(p[0] not in OWN and not OTHER.isdisjoint(p) for p in parts)


def _described(tag: str, attrs: str, inside: bool) -> tuple[str, bool]:
    """The element's mark, and whether its name, role or classes say that it is no part of an article."""
    other = tag in NOT_TEXT or tag == "header" and not inside
    mark = tag
    for name, a, b, c in _ATTR.findall(attrs) if attrs else ():
        name, value = name.lower(), (a or b or c).lower()
        if name == "hidden" or name == "aria-hidden" and value == "true" or name == "role" and value in ROLES:
            other = True
        elif name in ("class", "id"):
            if name == "class":
                mark += "." + _NUMBER.sub("", value)
            other = other or tag not in ("html", "body", "article", "main") and _names_other(name, value, tag, inside)
    return mark, other


def parse(source: str) -> Node:
    """The tree of a page, however deep. Tags may lack ends, nest wrongly or break off; nothing makes it fail."""
    root = Node("#")
    stack, at, size = [root], 0, len(source)
    opened: Counter[str] = Counter()  # of the names on the stack
    while at < size:
        m = _TOKEN.search(source, at)
        if not m:
            stack[-1].kids.append(source[at:])
            break
        if m.start() > at:
            stack[-1].kids.append(source[at : m.start()])
        at = m.end()
        tag = m[2]
        if tag is None:
            if m[0].startswith("<![CDATA["):
                stack[-1].kids.append(entities.escape(m[0][9:].removesuffix("]]>"), quote=False))
            continue
        tag = tag.lower()
        if m[1]:
            if tag == "br":
                stack[-1].kids.append(Node("br"))
            for i in range(len(stack) - 1, 0, -1) if opened[tag] else ():
                if stack[i].tag == tag:
                    _cut(stack, i, opened)
                    break
                if stack[i].tag in ("td", "th", "table") and tag not in ("table", "tr", "tbody", "thead", "tfoot", "body", "html"):
                    break
            continue
        _close_for(tag, stack, opened)
        inside = stack[-1].inside or stack[-1].tag in SLOTS
        mark, other = _described(tag, m[3], inside)
        node = Node(tag, mark, inside, other)
        stack[-1].kids.append(node)
        if tag in RAW and not m[3].endswith("/"):
            end = re.compile(rf"</{re.escape(tag)}\s*[^>]*(?:>|$)", re.I).search(source, at)
            if tag in ("title", "textarea"):
                node.kids.append(source[at : end.start() if end else size])
            at = end.end() if end else size
        elif tag not in VOID and not (m[3].endswith("/") and tag in ("path", "circle", "rect")):
            stack.append(node)
            opened[tag] += 1
    _measure(root)
    return root


def _measure(root: Node) -> None:
    """Sets size and digest of all nodes, of text without white space and without nodes that are other."""
    order, todo = [], [root]
    while todo:
        node = todo.pop()
        order.append(node)
        todo.extend(k for k in node.kids if not isinstance(k, str))
    for node in reversed(order):
        parts: list = []
        for kid in node.kids:
            if isinstance(kid, str):
                text = "".join(entities.unescape(kid).split())
                if text:
                    parts.append(text)
                    node.size += len(text)
            elif kid.size and not kid.other:
                parts.append(kid.digest)
                node.size += kid.size
        node.digest = parts[0] if len(parts) == 1 and isinstance(parts[0], int) else hash(tuple(parts)) if parts else 0


def _cut(stack: list[Node], i: int, opened: Counter) -> None:
    opened.subtract(n.tag for n in stack[i:])
    del stack[i:]


def _close_for(tag: str, stack: list[Node], opened: Counter) -> None:
    """Ends the elements that a start tag ends by itself."""
    if tag in CLOSES_P:
        _close("p", stack, opened, BLOCK - {"p"})
    if tag == "li":
        _close("li", stack, opened, frozenset(("ul", "ol", "menu", "table")))
    elif tag in ("dd", "dt"):
        _close("dd", stack, opened, frozenset(("dl",)))
        _close("dt", stack, opened, frozenset(("dl",)))
    elif tag == "option":
        _close("option", stack, opened, frozenset(("select",)))
    elif tag in ("td", "th"):
        _close("td", stack, opened, frozenset(("tr", "table")))
        _close("th", stack, opened, frozenset(("tr", "table")))
    elif tag in ("tr", "tbody", "tfoot"):
        _close("tr", stack, opened, frozenset(("table",)))
    elif tag == "body":
        _close("head", stack, opened, frozenset(("body",)))


def _close(tag: str, stack: list[Node], opened: Counter, stop: frozenset) -> None:
    for i in range(len(stack) - 1, 0, -1) if opened[tag] else ():
        if stack[i].tag == tag:
            _cut(stack, i, opened)
            return
        if stack[i].tag in stop:
            return


def squeeze(text: str) -> str:
    return _SPACE.sub(" ", entities.unescape(text)).strip()


def blocks(node: Node, constant: set[int] | None = None) -> list[str]:
    """Texts of the blocks under a node, in order, without what is marked as other or constant."""
    found: list[str] = []
    parts: list[str] = []

    def flush() -> None:
        text = squeeze("".join(parts))
        if text:
            found.append(text)
        parts.clear()

    todo: list = [iter(node.kids)]
    ends: list[bool] = [True]
    while todo:
        kid = next(todo[-1], None)
        if kid is None:
            todo.pop()
            if ends.pop():
                flush()
        elif isinstance(kid, str):
            parts.append(kid)
        elif kid.tag in ("br", "hr"):
            parts.append(" ")
        elif not (kid.other or constant and id(kid) in constant):
            block = kid.tag in BLOCK
            if block:
                flush()
            todo.append(iter(kid.kids))
            ends.append(block)
    flush()
    return found


def elements(node: Node) -> list[Node]:
    return [k for k in node.kids if not isinstance(k, str) and k.tag not in ("br", "hr")]


def numbered(root: Node) -> list[Node]:
    """All elements that take part in the alignment, in order, each with its number."""
    out, todo = [], [root]
    while todo:
        node = todo.pop()
        node.number = len(out)
        out.append(node)
        if not node.other and node.tag not in UNITS:
            todo.extend(reversed(elements(node)))
    return out


def common(x: list, y: list) -> list[tuple[int, int]]:
    """Places (i, j) of a longest common subsequence of two lists, in order.

    What is equal at both ends is matched first. The rest goes by rows of bits: bit j of row i is 0 where one more of y
    is common to the first i of x. Only each ROWS-th row is kept; those between are worked out again on the way back.
    """
    head, m, n = 0, len(x), len(y)
    while head < min(m, n) and x[head] == y[head]:
        head += 1
    while m > head and n > head and x[m - 1] == y[n - 1]:
        m, n = m - 1, n - 1
    found = [(m + k, n + k) for k in range(len(x) - m - 1, -1, -1)]
    width, where = n - head, {}
    for j in range(head, n):
        where[y[j]] = where.get(y[j], 0) | 1 << (j - head)
    every = (1 << width) - 1

    def below(row: int, i: int) -> int:
        hit = row & where.get(x[i], 0)
        return (row + hit | row - hit) & every

    kept, row = [every], every
    for i in range(head, m):
        row = below(row, i)
        if (i + 1 - head) % ROWS == 0:
            kept.append(row)
    i, j, low, rows = m, n, m, [row]
    while i > head and j > head:
        if i == low and i > head:  # rows of places low .. i
            low = head + (i - 1 - head) // ROWS * ROWS
            rows = [kept[(low - head) // ROWS]]
            for k in range(low, i):
                rows.append(below(rows[-1], k))
        if x[i - 1] == y[j - 1]:
            i, j = i - 1, j - 1
            found.append((i, j))
        elif rows[i - low] >> (j - 1 - head) & 1:
            j -= 1
        else:
            i -= 1
    return [*((k, k) for k in range(head)), *reversed(found)]


def beside(x: list[Node], y: list[Node]) -> list[tuple[Node, Node]]:
    """Children of two nodes matched in order: those of equal marks, and between them those of equal names."""
    pairs = []
    last = (-1, -1)
    for end in [*common([(k.mark, k.other) for k in x], [(k.mark, k.other) for k in y]), (len(x), len(y))]:
        p, q = x[last[0] + 1 : end[0]], y[last[1] + 1 : end[1]]
        if p and q:
            pairs += [(p[i], q[j]) for i, j in common([(k.tag, k.other) for k in p], [(k.tag, k.other) for k in q])]
        if end[0] < len(x):
            pairs.append((x[end[0]], y[end[1]]))
        last = end
    return pairs


def aligned(model: Node, page: Node) -> list[tuple[Node, Node]]:
    """Simple tree matching: pairs of nodes of equal names that keep parents and order, level by level.

    Units (paragraphs, headings, list items) and nodes marked as other count as leaves.
    """
    pairs, todo = [], [(model, page)]
    while todo:
        a, b = todo.pop()
        pairs.append((a, b))
        if not (a.other or b.other or a.tag in UNITS):
            todo.extend(beside(elements(a), elements(b)))
    return pairs


def evidence(model: Node, page: Node) -> dict[int, tuple[int, int, int]]:
    """What one page says of the model's nodes: (number, aligned, same text, length of its text)."""
    return {a.number: (1, int(a.digest == b.digest), 0 if b.other else b.size) for a, b in aligned(model, page)}


def wrapper(model: Node, seen: dict[int, tuple[int, int, int]]) -> tuple[int, list[int]]:
    """(slot, constant): number of the node that holds the varying content, and the template's nodes in it.

    The slot is the lowest node that holds all varying text of all pages; the way to it enters no unit of text, and
    ends at an article (extract takes the articles beside it).
    """
    nodes = numbered(model)

    def constant(n: Node) -> bool:
        pages, same, _ = seen.get(n.number, (0, 0, 0))
        return pages >= CONSTANT_PAGES and same >= CONSTANT_SHARE * pages and n.size > 0

    def size(n: Node) -> int:
        return 0 if n.other else seen.get(n.number, (0, 0, 0))[2]

    node = model
    while node.tag not in SLOTS:
        inside = [k for k in elements(node) if not k.other and k.number >= 0]
        marked = [k for k in inside if k.tag in SLOTS and seen.get(k.number)]
        varying = [k for k in inside if size(k) and not constant(k)]
        template = sum(size(k) for k in inside if constant(k))
        top = max(marked, key=size, default=None) or (varying[0] if len(varying) == 1 and varying[0].tag not in UNITS else None)
        if top is None or not marked and size(top) + template < size(node):  # else text beside it, or nodes that only other pages have
            break
        node = top
    return node.number, [n.number for n in nodes if constant(n) and n is not node and n is not model and (n.tag in UNITS or n.tag in ("div", "section", "ul", "ol", "table", "header", "p"))]


def extract(source: str | None, model: Node | None, slot: int, constant: set[int]) -> str:
    """Main text of a page by the wrapper of its host; of a page that the wrapper doesn't fit, by its own tree."""
    if not source:
        return ""
    page = parse(source)
    if model is None:
        model = page
        slot, own = wrapper(page, {n.number: (1, 0, 0 if n.other else n.size) for n in numbered(page)})
        constant = set(own)
    there, template = None, set()
    for a, b in aligned(model, page):
        if a.number == slot:
            there = b
        if a.number in constant:
            template.add(id(b))
    if there is None or there.tag == "#":
        first = next((n for n in numbered(page) if n.tag in SLOTS and not n.other), None)
        there = first or there or page
    found = [there]
    if there.tag in SLOTS:
        row = next((elements(n) for n in numbered(page) if any(k is there for k in elements(n))), found)
        found = [k for k in row if k.tag in SLOTS and not k.other or k is there]
    return "\n".join(b for slot_node in found for b in blocks(slot_node, template))


def host_of(url: str) -> Column:
    return F.lower(F.regexp_extract(F.coalesce(F.col(url), F.lit("")), r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)", 1))


def main_text(pages: DataFrame, staging: Staging) -> DataFrame:
    """page_id, url, text, n_chars of pages (page_id, url, html).

    The model tree of a host is that of its first page (smallest page_id with html). Every page of the host is
    aligned with it by simple tree matching, and what all of them say of each node (aligned, same text, length of
    text) is summed before the shuffle: nodes with the same text on nearly all pages are template, and the lowest subtree
    with all of the varying text is the slot of the content (articles side by side are one slot). A second pass aligns
    each page again and takes the slot's blocks, without the template's and without elements that by name, class or
    role are no part of an article.

    Pages of any depth and with any number of siblings are aligned whole. Outside of article and main elements the
    words of OTHER in names, and header elements, mark what is no part of the article; inside, only whole classes do.

    A host with one page, a null url, or a page that the wrapper doesn't fit go by their own tree in the same way.
    Null or empty html gives an empty text. Repeated page_ids count once, with their smallest html and url.
    """
    if _repeated(pages):
        rows = pages.groupBy(F.col("page_id").cast("long").alias("page_id")).agg(F.min("url").alias("url"), F.min("html").alias("html"))
    else:
        rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html")
    rows = rows.withColumn("host", host_of("url"))
    first = rows.where("length(html) > 0 AND host <> ''").groupBy("host").agg(F.min("page_id").alias("page_id"))
    first = staging.save(first, "first")
    models = staging.save(rows.select("page_id", F.col("html").alias("model")).join(_sent(first, F.octet_length("host") + 8), "page_id").select("host", "model"), "models")
    own = F.octet_length("host") + F.octet_length("model")

    def say(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees: dict[str, Node] = {}
        for batch in batches:
            total: dict[tuple[str, int], list[int]] = {}
            for host, model, source in zip(*(batch.column(c).to_pylist() for c in ("host", "model", "html")), strict=True):
                tree = _tree(trees, host, model)
                for number, (a, b, c) in evidence(tree, parse(source)).items():
                    t = total.setdefault((host, number), [0, 0, 0])
                    t[0] += a
                    t[1] += b
                    t[2] += c
            yield pa.RecordBatch.from_arrays(
                [pa.array([k[0] for k in total], pa.string()), pa.array([k[1] for k in total], pa.int32()), *(pa.array([v[i] for v in total.values()], pa.int64()) for i in range(3))], names=["host", "number", "pages", "same", "chars"]
            )

    seen = rows.where("length(html) > 0").join(_sent(models, own), "host").select("host", "model", "html").mapInArrow(say, "host string, number int, pages long, same long, chars long")
    seen = seen.groupBy("host", "number").agg(*(F.sum(c).alias(c) for c in ("pages", "same", "chars")))
    seen = seen.groupBy("host").agg(F.collect_list(F.struct("number", "pages", "same", "chars")).alias("seen"))
    wrappers = staging.save(models.join(seen, "host"), "wrappers")

    def take(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees: dict[str, Node] = {}
        known: dict[str, tuple[int, set[int]]] = {}
        for batch in batches:
            texts = []
            for host, model, said, source in zip(*(batch.column(c).to_pylist() for c in ("host", "model", "seen", "html")), strict=True):
                if model is None:
                    texts.append(extract(source, None, 0, set()))
                    continue
                tree = _tree(trees, host, model)
                if host not in known:
                    slot, constant = wrapper(tree, {s["number"]: (s["pages"], s["same"], s["chars"]) for s in said})
                    known[host] = slot, set(constant)
                texts.append(extract(source, tree, *known[host]))
            yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string())], names=["page_id", "url", "text"])

    out = rows.join(_sent(wrappers, own + 28 * F.size("seen")), "host", "left").select("page_id", "url", "host", "model", "seen", "html").mapInArrow(take, "page_id long, url string, text string")
    return out.withColumn("n_chars", F.length("text").cast("long"))


def _sent(table: DataFrame, size: Column) -> DataFrame:
    """The table, to be sent to all tasks if its rows have SENT_BYTES at most, so that the pages it meets stay where they
    are; else it meets them by an equi-join, whose large hosts Spark splits."""
    return F.broadcast(table) if (table.agg(F.sum(size)).first()[0] or 0) <= SENT_BYTES else table


def _tree(trees: dict[str, Node], host: str, source: str) -> Node:
    if host not in trees:
        if len(trees) > 256:
            trees.clear()
        trees[host] = parse(source)
        numbered(trees[host])
    return trees[host]


def _repeated(pages: DataFrame) -> bool:
    return not pages.groupBy("page_id").agg(F.count(F.lit(1)).alias("c")).where("c > 1").isEmpty()


def op10_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    return main_text(table(spark, sf_dir, "pages"), Staging(spark, "op10"))
