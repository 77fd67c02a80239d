"""Geometric kernels, vector tiles, file formats, graph walks and documented numbers."""

import gzip
import math
import struct
import zlib

import numpy as np
import pandas as pd
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from cartoloom import sources, streaming
from cartoloom.functions import geo, numbers, shapes
from cartoloom.functions import tags as t
from cartoloom.functions import vector_tiles as vt
from cartoloom.functions import wire
from cartoloom.operators import networks, places, rasters, regions, sequences, tiles
from pyspark.sql import functions as F

lines = st.lists(st.tuples(st.integers(-50, 50), st.integers(-50, 50)), min_size=2, max_size=30).map(lambda p: np.array(p, float))


def distance(p, a, b):
    d = b - a
    n = d @ d
    s = np.clip((p - a) @ d / n, 0, 1) if n else 0.0
    return math.hypot(*(p - a - s * d))


@given(lines, st.floats(0.1, 20))
@settings(max_examples=60, deadline=None)
def test_simplified_lines_stay_near(line, tolerance):
    out = shapes.simplified(line, tolerance)
    assert (out[0] == line[0]).all() and (out[-1] == line[-1]).all()
    for p in line:
        assert min(distance(p, a, b) for a, b in zip(out[:-1], out[1:])) <= tolerance + 1e-9


@given(lines)
@settings(max_examples=60, deadline=None)
def test_clipped_parts_are_inside_and_whole(line):
    parts = shapes.clipped(line, -20, -20, 20, 20)
    inside = sum(math.hypot(*(b - a)) for p in parts for a, b in zip(p[:-1], p[1:]))
    assert all((np.abs(p) <= 20 + 1e-9).all() for p in parts)
    steps = [a + (b - a) * i / 400 for a, b in zip(line[:-1], line[1:]) for i in np.arange(0.5, 400)]
    sizes = [math.hypot(*(b - a)) / 400 for a, b in zip(line[:-1], line[1:]) for _ in range(400)]
    assert abs(sum(z for s, z in zip(steps, sizes) if (np.abs(s) <= 20).all()) - inside) <= 0.02 * len(line) * 150


def test_joined_lines_and_wkb():
    got = shapes.joined([[(0, 0), (1, 0)], [(2, 0), (1, 0)], [(2, 0), (3, 1)], [(9, 9), (8, 8)]])
    assert sorted(len(g) for g in got) == [2, 4]
    line = np.array([[1.5, 2], [3, 4]])
    assert (shapes.wkb_line(shapes.line_wkb(line)) == line).all()
    x, y = shapes.point_inside(np.array([[0, 0], [4, 0], [4, 4], [3, 4], [3, 1], [1, 1], [1, 4], [0, 4], [0, 0]], float))
    assert 0 < y < 4 and (0 < x < 1 or 3 < x < 4)


def test_vector_tiles():
    f = lambda i, g: (i, 1, wire.number_bytes([9, g, 4]), {"a": "x", "n": -3})
    one = vt.tile_of([vt.Layer.of("l", [f(1, 2), f(2, 3)])])
    two = vt.tile_of([vt.Layer.of("l", [f(7, 2)]), vt.Layer.of("m", [f(None, 5), (8, 2, b"", {})], version=1, extent=512)])
    odd = vt.tile_of([vt.Layer.of("l", [f(1, 9)], extent=512)])
    assert vt.tile_of(vt.layers(one)) == one and vt.tile_of(vt.layers(two)) == two
    both = {x.name: x for x in vt.layers(vt.together([one, two, odd]))}
    assert [len(both[k]) for k in ("l", "m")] == [2, 2] and both["m"].ids == [None, 8] and both["m"].extent == 512
    assert vt.layers(gzip.decompress(vt.end_to_end(gzip.compress(one), gzip.compress(two))))[2].name == "m"
    a = vt.tile_of([vt.Layer.of("l", [(1, 1, b"s", {"k": "v", "q": 1.5}), (2, 1, b"t", {"z": True})])])
    b = vt.tile_of([vt.Layer.of("l", [(9, 1, b"t", {"z": True}), (3, 1, b"s", {"q": 1.5, "k": "v"})])])
    (joined,) = vt.layers(vt.together([b, a]))
    assert joined.ids == [9, 3, 1] and joined.keys == [b"z", b"q", b"k"]
    assert vt.layers(vt.together([])) == []


def test_wire():
    values = [0, 1, 127, 128, 300, 2**32, 2**63, 2**64 - 1]
    assert wire.numbers(wire.number_bytes(values)).tolist() == values and wire.number_bytes([300]) == b"\xac\x02"
    assert wire.signed(np.array([0, 1, 2, 3, 2**64 - 1], np.uint64)).tolist() == [0, -1, 1, -2, -(2**63)]
    found = wire.Message(wire.message((1, 5), (2, b"ab"), (1, 700), (3, 0.5), (4, None)))
    assert found.all(1) == [5, 700] and bytes(found.last(2)) == b"ab" and bytes(found.last(3)) == np.float64(0.5).tobytes() and found.last(4) is None
    for broken in (bytes([3, 0]), b"\x80"):
        with pytest.raises((ValueError, IndexError)):
            wire.Message(broken)
    with pytest.raises(ValueError):
        wire.numbers(b"\x80")


def test_files(spark, tmp_path):
    sources.register(spark)
    rows = spark.createDataFrame([(3, x, y, b"same" if x < 2 else b"%d" % y) for x in range(4) for y in range(3)], "z int, x int, y int, data binary")
    place, content = tiles.stored(rows)
    sources.write_mbtiles(place, content, f"{tmp_path}/a.mbtiles", {"name": "t"})
    back = spark.read.format("mbtiles").load(f"{tmp_path}/a.mbtiles")
    assert {tuple(r) for r in back.collect()} == {tuple(r) for r in rows.collect()} and content.count() == 4
    grid = np.array([[1, -9], [3, 4.5]])
    np.save(f"{tmp_path}/g.npy", grid)
    assert {tuple(r) for r in spark.read.format("npy").option("nodata", -9).load(f"{tmp_path}/g.npy").collect()} == {(0, 0, 1.0), (1, 0, 3.0), (1, 1, 4.5)}
    (tmp_path / "g.asc").write_text("ncols 2\nnrows 2\nxllcorner 100\nyllcorner 50\ncellsize 50\nnodata_value -1\n1 2\n-1 4\n")
    cells = sources.cells_of_ascii_grid(spark.read.format("binaryFile").load(f"{tmp_path}/g.asc"))
    assert {tuple(r) for r in cells.collect()} == {(1, 2, 0.0), (1, 3, 4.0), (2, 2, 1.0), (2, 3, 2.0)}
    line = spark.createDataFrame([([(0.0, 1.0), (2.0, 3.0)], 5)], "line array<struct<x:double,y:double>>, heat int")
    sources.write_geopackage(line, f"{tmp_path}/w.gpkg", "walked")
    assert (tmp_path / "w.gpkg").stat().st_size > 0


def test_heat_png(spark):
    rng = np.random.default_rng(1)
    want = rng.integers(0, 40, (12, 9)).astype(np.uint8)
    raw, before = b"", np.zeros(9, np.int32)
    for y, row in enumerate(want.astype(np.int32)):
        how = y % 5
        left = np.concatenate([[0], row[:-1]])
        corner = np.concatenate([[0], before[:-1]])
        p = left + before - corner
        pick = np.array([min((abs(v - a), 0, a), (abs(v - b), 1, b), (abs(v - c), 2, c))[2] for v, a, b, c in zip(p, left, before, corner)])
        raw += bytes([how]) + ((row - [0 * row, left, before, (left + before) >> 1, pick][how]) & 255).astype(np.uint8).tobytes()
        before = row
    chunk = lambda k, b: struct.pack(">I", len(b)) + k + b + struct.pack(">I", zlib.crc32(k + b))
    png = lambda kind: b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", 9, 12, 8, kind, 0, 0, 0)) + chunk(b"IDAT", zlib.compress(raw)) + chunk(b"IEND", b"")
    assert (sources.read_heat_png(png(3)) == want).all()
    with pytest.raises(ValueError):
        sources.read_heat_png(png(0))
    found = sources.cells_of_heat_png(spark.createDataFrame([(4, 5, png(3))], "x int, y int, data binary"))
    assert found.count() == int((want > 0).sum())


def test_documented_numbers(spark):
    one = lambda *c: spark.range(1).select(*c).first()
    levels = spark.range(256).select(numbers.heat_level(F.col("id").cast("double")).alias("v")).distinct().collect()
    assert sorted(r.v for r in levels) == [0, 1, 2, 3, 4, 6, 8, 11, 16, 23, 32, 45, 64, 91, 128, 181, 255]
    assert one(numbers.size_extra(F.lit(4)), numbers.size_extra(F.lit(100))) == (750.0, 150.0)
    a, b, c = one(*(numbers.boost(F.lit(float(s))) for s in (25, 30, 35)))
    assert [round((x - 1) / 1.1, 1) for x in (a, b, c)] == [0.1, 0.5, 0.9]
    even = one(numbers.steepness(F.lit(300.0), *(F.lit(100.0),) * 3))[0]
    assert math.isclose(even, math.degrees(math.atan2(300, 300)))
    cliff = one(numbers.score(F.lit(100.0), F.lit(0.0), F.lit(90.0)))[0]
    assert math.isclose(cliff, 210, rel_tol=1e-6)
    assert one(t.speed_limit(F.lit("IT:rural")), t.speed_limit(F.lit("30 mph")), t.speed_limit(F.lit("none"))) == (90.0, 30 * 1.609, None)
    east, north = one(*geo.to_grid(F.lit(54.0), F.lit(-2.0), -2.0))
    assert abs(east) < 1e-6 and abs(north - 5_985_500) < 1500


def brute_network(spark):
    rng = np.random.default_rng(3)
    edge = [(i, int(a), int(b), float(rng.integers(1, 50))) for i, (a, b) in enumerate(rng.integers(0, 60, (70, 2)))]
    return edge, spark.createDataFrame(edge, "e long, u long, v long, length double")


def reach(arcs):
    out = {n: {n} for a in arcs for n in a}
    for _ in out:
        for u, v in arcs:
            out[u] |= out[v]
    return out


def test_components(spark):
    edge, df = brute_network(spark)
    weak, strong = reach([(u, v) for _, u, v, _ in edge] + [(v, u) for _, u, v, _ in edge]), reach([(u, v) for _, u, v, _ in edge])
    assert {r.node: r.root for r in networks.weak_components(df).collect()} == {n: min(x) for n, x in weak.items()}
    want = {n: min(m for m in x if n in strong[m]) for n, x in strong.items()}
    assert {r.node: r.root for r in networks.strong_components(df.select("u", "v")).collect()} == want


def test_nearest_sources_and_round_walks(spark):
    edge, df = brute_network(spark)
    arcs = df.select("u", "v", F.col("length").alias("cost")).union(df.select("v", "u", "length"))
    start = {3: 5.0, 11: 0.0, 40: 9.0}
    best = {}
    for s, offset in start.items():
        dist = {s: offset}
        for _ in range(60):
            for _, u, v, c in edge:
                for a, b in ((u, v), (v, u)):
                    if a in dist and dist[a] + c < dist.get(b, math.inf):
                        dist[b] = dist[a] + c
        for n, d in dist.items():
            if d <= 80:
                best[n] = min(best.get(n, (math.inf, 0)), (d, s))
    src = spark.createDataFrame([(s, s, o) for s, o in start.items()], "node long, source long, offset double")
    assert {r.node: (r.dist, r.source) for r in networks.nearest_sources(arcs, src, 80.0).collect()} == best
    square = [(0, 1, 2, 100.0), (1, 2, 3, 100.0), (2, 3, 4, 100.0), (3, 4, 1, 100.0), (4, 0, 1, 50.0), (5, 4, 9, 1.0)]
    rows = spark.createDataFrame([(7, 0, *e) for e in square], "area long, source long, e long, u long, v long, length double")
    got = networks.round_walks(rows, "area").collect()
    assert [(r.metres, r.shared) for r in got] == [(500.0, 50.0)]


def test_nearest_is_brute_force_at_the_edges(spark):
    pts = [(i, float(x), float(y)) for i, (x, y) in enumerate([(0, 0), (10, 0), (10, 10), (-10, 0), (0, 10.000001), (25, 25), (30, 25)])]
    df = spark.createDataFrame(pts, "id long, x double, y double")
    for strict in (False, True):
        want = {(a, b) for a, ax, ay in pts for b, bx, by in pts if (d := (ax - bx) ** 2 + (ay - by) ** 2) < 100 or d == 100 and not strict}
        assert {(r.a, r.b) for r in places.pairs_within(df, df, 10.0, strict).collect()} == want


def test_contours_and_smoothing(spark):
    grid = spark.createDataFrame([(r, c, float(10 * r)) for r in range(5) for c in range(4)], "r int, c int, v double")
    got = rasters.contour_segments(grid, 15.0).collect()
    assert {(s.level, s.y0) for s in got} == {(15.0, 1.5), (30.0, 3.0)} and len(got) == 6
    flat = spark.createDataFrame([(r, c, 7.0) for r in range(20) for c in range(20)], "r int, c int, v double")
    out = rasters.smoothed(flat, 1.0, block=8).collect()
    assert len(out) == 400 and all(abs(x.v - 7) < 1e-9 for x in out)
    step = np.zeros((20, 20))
    step[:, 10:] = 1
    rows = spark.createDataFrame([(r, c, float(step[r, c])) for r in range(20) for c in range(20)], "r int, c int, v double")
    a = {(x.r, x.c): x.v for x in rasters.smoothed(rows, 1.0, block=6).collect()}
    b = {(x.r, x.c): x.v for x in rasters.smoothed(rows, 1.0, block=64).collect()}
    assert all(abs(a[k] - b[k]) < 1e-9 for k in b)


def test_closing_against_plain_windows(spark):
    rng = np.random.default_rng(5)
    for size in (4, 5, 50):
        v = np.where(rng.random(90) < 0.5, 0, rng.integers(1, 9, 90)).astype(float)
        pad = np.pad(v, size, mode="edge")
        high = np.array([pad[i + size - size // 2 : i + size + size - size // 2].max() for i in range(90)])
        wide = np.pad(high, size, mode="edge")
        back = size - size // 2 - 1
        want = [wide[i + size - back : i + size - back + size].min() for i in range(90)]
        df = spark.createDataFrame([(1, i, float(x)) for i, x in enumerate(v)], "way_id long, seq int, heat double")
        got = [r.filled for r in sequences.gaps_filled(df, "heat", size).orderBy("seq").collect()]
        assert got == want


def test_incremental(spark, tmp_path):
    tiles_ = spark.createDataFrame([(x, y, f"h{x}{y}") for x in range(5) for y in range(5)], "x int, y int, hash string")
    update = streaming.updates_to(f"{tmp_path}/keys", "v1")
    update(tiles_, 0)
    known = spark.read.parquet(f"{tmp_path}/keys")
    assert known.count() == 25 and streaming.changed(tiles_, known, "v1").count() == 0
    other = tiles_.withColumn("hash", F.when((F.col("x") == 0) & (F.col("y") == 0), "new").otherwise(F.col("hash")))
    assert {(r.x, r.y) for r in streaming.changed(other, known, "v1").collect()} == {(0, 0), (0, 1), (1, 0), (1, 1)}
    assert streaming.changed(tiles_, known, "v2").count() == 25


def test_region_graph():
    nodes = pd.DataFrame({"lat_e7": [1, 2, 3], "lon_e7": [4, 5, 6]})
    edges = pd.DataFrame({"u": [0, 1], "v": [1, 2], "length": [1.0, 2.0], "cost_f": [1.0, np.inf], "cost_b": [1.0, 2.0]})
    data = sources.write_region_graph(edges, nodes)
    assert struct.unpack_from("<4i", data) == (0x52474D4D, 1, 3, 2)
    at = 64 + 16 + 16
    assert struct.unpack_from("<4i", data, at) == (0, 1, 3, 4) and struct.unpack_from("<4i", data, at + 16) == (0, 1, -1, -2)


def test_distances():
    rng = np.random.default_rng(4)
    mask = rng.random((17, 23)) < 0.05
    mask[3, 4] = True
    at = np.argwhere(mask)
    want = np.array([[min(math.hypot(r - y, c - x) for y, x in at) for c in range(23)] for r in range(17)])
    assert np.allclose(rasters.distances(mask), want)


def test_grid_extent_and_metadata(spark):
    area = spark.createDataFrame([(1, -1.0, 50.0, 1.0, 51.0)], "id int, west double, south double, east double, north double")
    got = geo.grid_extent(area, 0.0, 25.0).first()
    assert got.x0 == -80_000 and got.y0 % 10_000 == 0 and 5_500_000 < got.y0 < 5_600_000 and got.cols > 5900 and got.rows > 4400
    meta = lambda n: spark.createDataFrame([("bounds", n), ("json", '{"vector_layers": [{"id": "%s"}]}' % n)], "name string, value string")
    out = {r.name: r.value for r in tiles.merged_metadata(meta("a"), meta("b"), {"format": "pbf"}).collect()}
    assert out == {"bounds": "a", "format": "pbf", "json": '{"vector_layers":[{"id":"a"},{"id":"b"}]}'}


def test_regions_of_points(spark):
    box = lambda x0, y0, x1, y1: [{"x": x, "y": y} for x, y in ((x0, y0), (x1, y0), (x1, y1), (x0, y1), (x0, y0))]
    shapes = {"alps": [box(0, 0, 10, 10)], "slovenia": [box(10, 0, 12, 2)], "france": [box(-5, 0, 3, 8), box(-4, 1, -3, 2)], "monaco": [box(3, 0, 4, 1)], "italy": [box(3, -5, 9, 5)], "austria": [box(5, 5, 20, 9)]}
    features = spark.createDataFrame(list(shapes.items()), "id string, rings array<array<struct<x:double,y:double>>>".replace("struct<x:double,y:double>", "struct<x:int,y:int>"))
    points = spark.createDataFrame([(1, 1.0, 1.0), (2, -3.5, 1.5), (3, -1.0, 1.0), (4, 3.5, 0.5), (5, 11.0, 1.0), (6, 15.0, 7.0), (7, 4.0, -2.0), (8, 99.0, 99.0)], "id long, x double, y double")
    got = {(r.id, r.region) for r in regions.regions_of(points, regions.defined(spark, ["alps", "slovenia", "italy"]), features).collect()}
    assert got == {(1, "alps"), (1, "alps-france"), (4, "alps"), (4, "alps-france"), (4, "alps-italy"), (4, "italy"), (5, "alps"), (5, "slovenia"), (7, "italy")}
    assert regions.defined(spark).where("download").count() == 16


def test_layouts(tmp_path):
    np.save(f"{tmp_path}/a.npy", np.zeros((20, 14), np.int16))
    found = sources.files.layout_of(f"{tmp_path}/a.npy")
    assert found["cell"] == 50_000 and found["scale"] == 0.1 and found["sea"] == -25 and (found["rows"], found["columns"]) == (20, 14)
    sources.files.write_layout(f"{tmp_path}/a.npy", found | {"crs": "EPSG:4326", "smooth": 2.0})
    again = sources.files.layout_of(f"{tmp_path}/a.npy")
    assert again == found | {"crs": "EPSG:4326", "smooth": 2.0}
