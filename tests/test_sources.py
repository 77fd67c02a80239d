"""Readers of map extracts and outlines against files made here; skeletons and walks by invariants."""

import json
import struct
import zlib

import numpy as np
from pyspark.sql import functions as F

from cartoloom.functions.wire import message, number_bytes
from cartoloom.operators import networks, rasters
from cartoloom.sources import osm, vector


def put(field, value):
    return message((field, value))


def zigzag(n):
    return n << 1 if n >= 0 else -n * 2 - 1


def deltas(values):
    return number_bytes(zigzag(b - a) for a, b in zip([0, *values[:-1]], values))


def extract(path, blocks, stamp):
    def blob(kind, data):
        body = put(2, len(data)) + put(3, zlib.compress(data))
        head = put(1, kind) + put(3, len(body))
        return struct.pack(">I", len(head)) + head + body

    with open(path, "wb") as f:
        f.write(blob(b"OSMHeader", put(4, b"OsmSchema-V0.6") + put(32, stamp)))
        for b in blocks:
            f.write(blob(b"OSMData", b))


def block(strings, *groups):
    return put(1, b"".join(put(1, s.encode()) for s in strings)) + b"".join(put(2, g) for g in groups)


def test_osm_extract(spark, tmp_path):
    names = ["", "natural", "peak", "name", "Top", "highway", "path", "type", "route", "hiking", "main"]
    ids, lats, lons = [10, 11, 12, 13], [540000000, 540000100, -5, 7], [-30000000, -30000200, 9, 8]
    dense = put(1, deltas(ids)) + put(8, deltas(lats)) + put(9, deltas(lons)) + put(10, number_bytes([1, 2, 3, 4, 0, 0, 0, 0]))
    way = lambda i, refs: put(3, put(1, i) + put(2, number_bytes([5])) + put(3, number_bytes([6])) + put(8, deltas(refs)))
    rel = put(4, put(1, 77) + put(2, number_bytes([7, 8])) + put(3, number_bytes([8, 9])) + put(8, number_bytes([10])) + put(9, deltas([100])) + put(10, number_bytes([1])))
    extract(f"{tmp_path}/x.pbf", [block(names, put(2, dense)), block(names, way(100, [10, 11, 12]) + way(101, [10, 999]) + way(102, [13]), rel)], 1_700_000_000)
    osm.register(spark)
    rows = spark.read.format("osm").option("blocks", 1).load(f"{tmp_path}/x.pbf")
    assert rows.count() == 8 and osm.replicated_at(f"{tmp_path}/x.pbf") == 1_700_000_000
    ways = osm.located_ways(rows).collect()
    assert [(w.way_id, [tuple(n) for n in w.nodes], w.tags) for w in ways] == [(100, list(zip(ids, lats, lons))[:3], {"highway": "path"})]
    assert [tuple(r) for r in osm.hiking_routes(rows).collect()] == [(100, 77, "lwn", None, None)]
    assert [tuple(r) for r in osm.named_peaks(rows).collect()] == [(10, 540000000, -30000000, "Top", None)]
    some = spark.read.format("osm").option("keys", "highway").load(f"{tmp_path}/x.pbf")
    assert sorted(r.id for r in some.collect()) == [11, 12, 13, 100, 101, 102]
    

def test_areas(spark):
    place = {1: (0, 0), 2: (10, 0), 3: (10, 10), 4: (0, 10), 5: (2, 2), 6: (4, 2), 7: (4, 4), 8: (3, 3), 9: (3.5, 3), 10: (3.5, 3.5), 11: (20, 0), 12: (30, 0), 13: (30, 5)}
    nodes = [("node", i, y * 10**7, x * 10**7, {}, None, None) for i, (x, y) in ((i, (int(x * 2) / 2, int(y * 2) / 2)) for i, (x, y) in place.items())]
    nodes = [(t, i, int(y), int(x), g, r, m) for t, i, y, x, g, r, m in nodes]
    way = lambda i, refs, **tags: ("way", i, None, None, tags, refs, None)
    ways = [way(1, [1, 2, 3]), way(2, [1, 4, 3]), way(3, [5, 6, 7, 5], landuse="grass"), way(4, [8, 9, 10, 8]), way(5, [11, 12, 13, 11], area="no"), way(6, [11, 12]), way(7, [12, 13, 99])]
    rel = lambda i, refs, **tags: ("relation", i, None, None, tags, None, [("way", r, "outer") for r in refs])
    rels = [rel(50, [1, 2, 3, 4, 5], type="multipolygon", natural="water"), rel(51, [6], type="multipolygon"), rel(52, [1, 2, 7], type="boundary"), rel(53, [1, 2], type="route"), rel(54, [1, 2, 98], type="boundary")]
    got = {(r.type, r.id, r.part): r for r in osm.areas(spark.createDataFrame(nodes + ways + rels, osm.SCHEMA)).collect()}
    assert {k[:2] for k in got} == {("way", 3), ("relation", 50)}
    ring = lambda points: {(round(p.x, 6), round(p.y, 6)) for p in points}
    found = sorted((sorted(ring(r.ring)), sorted(map(sorted, map(ring, r.holes)))) for k, r in got.items() if k[0] == "relation")
    square, hole, island, far = ([place[i] for i in x] for x in ((1, 2, 3, 4), (5, 6, 7), (8, 9, 10), (11, 12, 13)))
    assert found == sorted([(sorted(square), [sorted(hole)]), (sorted(island), []), (sorted(far), [])])
    assert got["way", 3, 0].tags == {"landuse": "grass"} and got["relation", 50, 0].tags["natural"] == "water"


def test_outlines(spark, tmp_path):
    ring = [[0, 0], [0, 4], [4, 4], [4, 0], [0, 0]]
    hole = [[1, 1], [2, 1], [2, 2], [1, 2], [1, 1]]
    feature = lambda i, name, parent, g: {"properties": {"id": i, "name": name, "parent": parent}, "geometry": g}
    found = [feature("a", "Aland", None, {"type": "Polygon", "coordinates": [ring, hole]}), feature("a2", "Z", "a", {"type": "MultiPolygon", "coordinates": [[ring], [hole]]}), feature("a1", "Y", "a", {"type": "Polygon", "coordinates": [ring]})]
    (tmp_path / "i.json").write_text(json.dumps({"type": "FeatureCollection", "features": found}))
    rows = vector.geojson_regions(spark, f"{tmp_path}/i.json")
    assert {r.id: len(r.rings) for r in rows.collect()} == {"a": 2, "a2": 2, "a1": 1}
    assert [r.id for r in vector.region_tree(rows, "top", "All", ["a"], "x").collect()] == ["top", "a", "a1", "a2"]
    points = [p for r in (ring, hole) for p in r]
    body = struct.pack("<i4d2i2i", 5, 0, 0, 4, 4, 2, 10, 0, 5) + struct.pack("<20d", *[v for p in points for v in p])
    (tmp_path / "s.shp").write_bytes(b"\0" * 100 + struct.pack(">2i", 1, len(body) // 2) + body)
    files = spark.read.format("binaryFile").load(f"{tmp_path}/s.shp")
    assert [(r.outer, len(r.ring)) for r in vector.shapefile_rings(files).collect()] == [(True, 5), (False, 5)]
    assert vector.shapefile_rings(files, (10, 10, 12, 12)).count() == 0
    (tmp_path / "p.tsv").write_text("n5\t1.0\t2.0\t7\t40\nw6\t1.0\t2.0\t\t900\n")
    assert [r.key for r in vector.car_parks(spark, f"{tmp_path}/p.tsv", (0, 0, 3, 3)).collect()] == ["n5"]
    (tmp_path / "m.tsv").write_text("n5\t40\nw6\t90\nr7\t0\n")
    assert sorted(tuple(r) for r in vector.path_metres(spark, f"{tmp_path}/m.tsv").collect()) == [(15, 40), (19, 90), (23, 0)]
    assert vector.poly_text("n", [[(1, 2)]]) == "n\n1\n  1.0000000 2.0000000\nEND\nEND\n"


def test_skeletons():
    mask = np.zeros((30, 60), bool)
    mask[10:17, 3:57] = True
    line = rasters.thinned(mask)
    assert line.sum() >= 40 and (line & ~mask).sum() == 0 and line.sum(axis=0).max() <= 2
    assert (rasters.thinned(line) == line).all()
    assert rasters.without_spurs(line, 3).sum() == line.sum() - 6
    assert not rasters.without_spurs(line, 100).any()


def test_best_walks(spark):
    edges = [(0, 0, 1, 50.0), (1, 1, 2, 100.0), (2, 2, 3, 100.0), (3, 3, 4, 100.0), (4, 4, 1, 100.0), (5, 4, 9, 1.0)]
    rows = spark.createDataFrame([(7, 0, *e, e[0] != 4, e[0] not in (0, 5)) for e in edges], "area long, source long, e long, u long, v long, length double, popular boolean, offroad boolean")
    got = {r.e: (r.walk, r.popular, r.off, r.both) for r in networks.best_walks(rows, "area").collect()}
    assert set(got) == {1, 2, 3, 4} and all(w[0] == 500.0 for w in got.values())
    assert all(w[2] == 500.0 * 1 if 400 / 500 >= 0.8 else w[2] is None for w in got.values())
    assert got[4][1] == 500.0  # out over 4, back over the popular side


def test_short_gaps(spark):
    ways = spark.createDataFrame([(0, 1, 2, 9.0, 5, 7), (1, 2, 3, 9.0, 0, 0), (2, 3, 4, 9.0, 4, 4), (3, 4, 5, 9.0, 0, 0), (4, 2, 3, 99.0, 0, 0)], "e long, u long, v long, length double, head int, tail int")
    assert [tuple(r) for r in networks.gaps_between_walked(ways, 10.0).collect()] == [(1, 4)]
    assert F is not None
