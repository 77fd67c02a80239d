"""What only odd or larger tables have: several tiles at a place, many points in a cell, large networks."""

import duckdb
import pytest

from cartoloom import plans


@pytest.fixture(scope="module")
def crowded(tmp_path_factory):
    """Documents whose tiles share places (their key repeats after 60,431 ids), with copies and nulls; DuckDB over them."""
    folder = str(tmp_path_factory.mktemp("crowded"))
    con = duckdb.connect()
    con.execute(f"""COPY (SELECT i + 60431 * k AS doc_id, CASE WHEN i = 8 OR i = 22 AND k = 1 THEN NULL ELSE 't' || (i * (k + 1)) % 90 END AS text
        FROM range(300) a(i), range(3) b(k)) TO '{folder}/documents.parquet'""")
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{folder}/documents.parquet'")
    return folder, con


def same(spark, crowded, name, sql):
    df = plans.QUERIES[name](spark, crowded[0])
    cur = crowded[1].execute(f"SELECT {', '.join(df.columns)} FROM ({sql})")
    assert sorted(map(str, map(tuple, df.collect()))) == sorted(map(str, cur.fetchall()))


def test_ids_of_contents_first_at_one_place(spark, crowded):
    same(spark, crowded, "tile_dedup", plans.ORACLES["tile_dedup"])


def test_contents_first_at_one_place_are_kept_apart(spark):
    from cartoloom.operators import tiles

    rows = spark.createDataFrame([(8, 0, 0, "b"), (8, 0, 0, "a"), (8, 1, 0, "a"), (8, 1, 1, None)], "z int, x int, y int, data string")
    places, contents = tiles.stored(rows)
    assert sorted(r.place_id for r in places.collect()) == [1, 1, 1, 2]
    text = {r.data_id: r.data for r in contents.collect()}
    assert sorted(text) == [1, 2, 3] and sorted((r.x, r.y, str(text[r.data_id])) for r in places.collect()) == [(0, 0, "a"), (0, 0, "b"), (1, 0, "a"), (1, 1, "None")]


def test_cache_keys_of_crowded_places(spark, crowded):
    """The SQL leaves the order of several contents of one place open; with theirs by hash, all keys are its own."""
    sql = plans.ORACLES["cache_keys"]
    assert "ORDER BY b.x, b.y)" in sql
    same(spark, crowded, "cache_keys", sql.replace("ORDER BY b.x, b.y)", "ORDER BY b.x, b.y, b.h)"))


def test_walks_of_areas_take_a_cells_edges_once(spark):
    """Sources of a cell share its edges; the walks are those of each source alone."""
    import random

    from cartoloom.operators import networks

    rng = random.Random(5)
    edge = [(e, rng.randrange(40), rng.randrange(40), float(rng.randrange(1, 30))) for e in range(150)]
    sources = list(range(0, 40, 3))
    edges = spark.createDataFrame(edge, "e long, u long, v long, length double")
    areas = spark.createDataFrame([(0, 0, e[0]) for e in edge], "cell_y int, cell_x int, e long")
    at = spark.createDataFrame([(s, 0, 0) for s in sources], "source long, cell_y int, cell_x int")
    got = networks.walks_of_areas(edges, areas, at, 40.0, 90.0, most=4)
    alone = networks.round_walks(spark.createDataFrame([(s, s, *e) for s in sources for e in edge], "area long, source long, e long, u long, v long, length double"), "area", 40.0, 90.0)
    assert sorted(map(tuple, got.collect())) == sorted((r.source, r.e, r.metres, r.shared) for r in alone.collect()) != []


@pytest.fixture(scope="module")
def two_groups(spark):
    """Two networks with loops, edges side by side and of no length, and nodes out of reach; some flags are unknown."""
    import random

    rng = random.Random(8)
    edge = [(g, 7 * g, e, 7 * g + rng.randrange(50), 7 * g + rng.randrange(50), rng.choice([1, 1, 0 if g else 1]) * rng.random() * 30, rng.choice([True, True, True, None]), rng.random() < 0.9) for g in (0, 1) for e in range(120 + 60 * g)]
    return spark.createDataFrame(edge, "area long, source long, e long, u long, v long, length double, popular boolean, offroad boolean")


def test_round_walks_of_large_groups_in_parts(spark, two_groups):
    from cartoloom.operators import networks

    rows = two_groups.where("length > 0")
    whole, parts = (sorted(map(tuple, networks.round_walks(rows, "area", 60.0, 130.0, most=most).collect())) for most in (1000, 30))
    assert whole and whole == parts
    # equal ways with edges of no length may go by other nodes, but their metres are the same
    whole, parts = ({(r.area, r.e): r.metres for r in networks.round_walks(two_groups, "area", 60.0, 130.0, 1.0, most=most).collect()} for most in (1000, 30))
    assert len(whole) == len(parts) and all(whole[k] == parts[k] for k in whole.keys() & parts.keys())


def test_best_walks_of_large_groups_in_parts(spark, two_groups):
    from cartoloom.operators import networks

    rows = two_groups.where("length > 0")
    whole, parts = (sorted(map(str, networks.best_walks(rows, "area", 2.0, 60.0, 130.0, most=most).collect())) for most in (1000, 30))
    assert whole and whole == parts


def test_the_way_out_counts_twice_off_the_roads(spark):
    """300 m of the round and twice the 50 m to it, of 500."""
    from cartoloom.operators import networks

    edges = [(0, 0, 1, 50.0), (1, 1, 2, 100.0), (2, 2, 3, 100.0), (3, 3, 4, 100.0), (4, 4, 1, 100.0)]
    rows = spark.createDataFrame([(7, 0, *e, True, e[0] != 4) for e in edges], "area long, source long, e long, u long, v long, length double, popular boolean, offroad boolean")
    assert sorted((r.e, r.off) for r in networks.best_walks(rows, "area").collect()) == [(e, 500.0) for e in (1, 2, 3, 4)]


@pytest.fixture(scope="module")
def points(spark):
    """Whole metres, so that points lie at the rim itself and scores are equal; some scores are unknown."""
    import random

    rng = random.Random(9)
    return [(i, float(rng.randrange(-300, 900)), float(rng.randrange(1200)), None if i % 40 == 0 else float(rng.randrange(60))) for i in range(700)]


def test_counts_within_take_whole_cells(spark, points, monkeypatch):
    from cartoloom.operators import places

    monkeypatch.setattr(places, "pairs_within", None)  # no table of pairs is made
    got = places.counts_within(spark.createDataFrame(points, "id long, x double, y double, score double"), 250.0)
    want = []
    for i, x, y, s in points:
        near = [t for _, p, q, t in points if (x - p) ** 2 + (y - q) ** 2 <= 62_500]
        want.append((i, len(near), sum(s is not None and t is not None and t > s for t in near)))
    assert sorted(map(tuple, got.collect())) == want


def test_best_base_without_pairs(spark, points, monkeypatch):
    from cartoloom.functions import numbers
    from cartoloom.operators import places

    monkeypatch.setattr(places, "pairs_within", None)  # no table of pairs is made
    df = spark.createDataFrame([p for p in points if p[3] is not None], "id long, x double, y double, z double")
    got = {r.a: r.b for r in places.best_base(df, df, 150.0, numbers.jut_of).collect()}
    want = {}
    for i, x, y, z in points:
        near = [((x - p) ** 2 + (y - q) ** 2, z - t, j) for j, p, q, t in points if z is not None and t is not None and z > t and (x - p) ** 2 + (y - q) ** 2 <= 22_500]
        if near:
            want[i] = min((-(h * h) / (h * h + d * d) ** 0.5, j) for d, h, j in ((d2**0.5, h, j) for d2, h, j in near))[1]
    assert got == want


def test_snap_counts_are_those_of_cells(spark, monkeypatch):
    """Edges of several segments whose boxes overlap, and far ones, counted without spreading them over cells."""
    import random
    from collections import defaultdict

    from cartoloom.operators import networks

    rng = random.Random(3)
    rows = [(w, k, w * 64 + k, i, rng.randrange(-30, 60), rng.randrange(-50, 50)) for w in range(40) for k in range(2) for i in range(rng.choice([2, 2, 3, 6]))]
    df = spark.createDataFrame(rows, "way_id long, edge long, e long, seq int, lat_e7 int, lon_e7 int")
    want = defaultdict(list)
    for r in networks.snap_cells(df, 10).collect():
        want[r.cell_y, r.cell_x].append(r.e)
    monkeypatch.setattr(networks, "snap_cells", None)
    got = networks.snap_counts(df, 10).collect()
    assert {(r.cell_y, r.cell_x): (r.edges, r.numbers) for r in got} == {k: (len(v), sum(v)) for k, v in want.items()} and len(got) == len(want)


def test_shortest_ways_are_those_of_a_search_node_by_node():
    """Whole metres, so that ways are equal; in every other network some edges have no length."""
    import random

    import numpy as np
    import pandas as pd

    from cartoloom.operators import networks

    rng = random.Random(4)
    for k in range(60):
        edge = pd.DataFrame([(7 * e, 3 * rng.randrange(40), 3 * rng.randrange(40), float(rng.randrange(1 - k % 2, 9))) for e in range(rng.choice([1, 60, 200]))], columns=["e", "u", "v", "length"])
        held = networks.Walks(edge)
        for at, source in enumerate(held.nodes.tolist()):
            got, want = held.tree(source, 15.0), held._tree(at, 15.0)
            assert all(np.array_equal(getattr(got, c), getattr(want, c)) for c in ("nodes", "dist"))
            assert edge["length"].min() == 0 or all(np.array_equal(getattr(got, c), getattr(want, c)) for c in ("before", "step"))


def test_edges_with_places_leave_no_shuffles(spark):
    """The edges of the network, saved in slices; files of their shuffles are gone when they are done."""
    from cartoloom.operators import networks
    from cartoloom.plans import networks as plan

    folder = "/root/testdata/sf0.001"
    nodes = plan.derived(spark, folder, "nodes")
    files = lambda: spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().size()
    before = files()
    found = networks.placed_edges(plan._way_slices(spark, folder, 3), nodes)
    assert files() <= before
    at = {r.ref: (r.lat_e7, r.lon_e7) for r in nodes.collect()}
    got = sorted((r.way_id, r.edge, r.u, r.v, round(r.length, 6), r.lat_e7, r.lon_e7) for r in found.collect())
    assert got == sorted((r.way_id, r.edge, r.u, r.v, round(r.length, 6), *at[r.u]) for r in plan._edges(spark, folder).collect()) != []


def test_walks_of_groups_send_edges_no_oftener_than_asked(spark):
    """Many sources of a group share one part when its edges may be sent only once; with more parts walks are the same."""
    import random

    from cartoloom.operators import networks

    rng = random.Random(6)
    edge = spark.createDataFrame([(e % 2, e, e % 2 * 100 + rng.randrange(40), e % 2 * 100 + rng.randrange(40), float(rng.randrange(1, 30))) for e in range(300)], "area int, e long, u long, v long, length double")
    at = spark.createDataFrame([(s // 100, s) for s in (*range(0, 40, 3), *range(100, 140, 3))], "area int, source long")
    once, often = (sorted(map(tuple, networks.walks_of_groups(edge, at, ["area"], 40.0, 90.0, most=1, sent=sent).collect())) for sent in (1, 10**9))
    assert once and once == often
