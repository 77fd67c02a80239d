"""OpenStreetMap extracts in PBF: a splittable data source, and ways with their nodes' places."""

from __future__ import annotations

import struct
import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from ..functions.wire import Message, running, signed

SCHEMA = "type string, id long, lat_e7 int, lon_e7 int, tags map<string,string>, refs array<long>, members array<struct<type:string,ref:long,role:string>>"


class Blobs(InputPartition):
    def __init__(self, places: list[tuple[int, int]]):
        self.places = places


class OsmSource(DataSource):
    """spark.read.format("osm").option("keys", "highway,amenity").load(path): one row for each node, way or relation.

    keys: only elements with one of these tags, and all nodes without tags (they are places of ways). The file's
    blocks are dealt to partitions, ``blocks`` (8) each; every executor must be able to open the path.
    """

    @classmethod
    def name(cls) -> str:
        return "osm"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        keys = self.options.get("keys", "")
        return OsmReader(self.options["path"], frozenset(keys.split(",")) if keys else frozenset(), int(self.options.get("blocks", "8")))


class OsmReader(DataSourceReader):
    def __init__(self, path: str, keys: frozenset, blocks: int):
        self.path, self.keys, self.blocks = path.removeprefix("file:"), keys, blocks

    def partitions(self) -> list[InputPartition]:
        places = [(at, size) for kind, at, size in blobs(self.path) if kind == b"OSMData"]
        return [Blobs(places[i : i + self.blocks]) for i in range(0, len(places), self.blocks)] or [Blobs([])]

    def read(self, part: Blobs) -> Iterator[tuple]:
        with open(self.path, "rb") as f:
            for at, size in part.places:
                f.seek(at)
                for row in elements(inflated(f.read(size))):
                    if not self.keys or row[0] == "node" and not row[4] or self.keys & row[4].keys():
                        yield row


def blobs(path: str) -> Iterator[tuple[bytes, int, int]]:
    """(kind, place, size) of the blocks of a file; only their heads are read."""
    with open(path, "rb") as f:
        while head := f.read(4):
            about = Message(f.read(struct.unpack(">I", head)[0]))
            size = about.last(3)
            yield bytes(about.last(1)), f.tell(), size
            f.seek(size, 1)


def inflated(blob: bytes) -> bytes:
    about = Message(blob)
    if about.all(1):
        return bytes(about.last(1))
    if about.all(3):
        return zlib.decompress(about.last(3))
    raise ValueError("a block is packed in a way that is not supported")


def replicated_at(path: str) -> int | None:
    """Seconds since 1970 that the extract's head says it is of."""
    for kind, at, size in blobs(path):
        if kind == b"OSMHeader":
            with open(path, "rb") as f:
                f.seek(at)
                return Message(inflated(f.read(size))).last(32)
    return None


def _offset(block: Message, field: int) -> int:
    """A place's zero, which can be negative: 64 bits in two's complement."""
    value = block.last(field, 0)
    return value - (1 << 64) if value >> 63 else value


def elements(block: bytes) -> Iterator[tuple]:
    """Rows of SCHEMA in a block of data."""
    whole = Message(block)
    strings = [bytes(s).decode() for table in whole.all(1) for s in Message(table).all(1)]
    grain, lat0, lon0 = whole.last(17, 100), _offset(whole, 19), _offset(whole, 20)
    place = lambda v, zero: (zero + grain * v) // 100

    def tags(own: Message) -> dict[str, str]:
        return {strings[k]: strings[v] for k, v in zip(own.numbers(2).tolist(), own.numbers(3).tolist(), strict=True)}

    for group in map(Message, whole.all(2)):
        for own in map(Message, group.all(1)):
            i, lat, lon = signed(np.array([own.last(k) for k in (1, 8, 9)], np.uint64)).tolist()
            yield "node", i, place(lat, lat0), place(lon, lon0), tags(own), None, None
        for own in map(Message, group.all(2)):
            yield from _dense(own, strings, place, lat0, lon0)
        for own in map(Message, group.all(3)):
            yield "way", own.last(1), None, None, tags(own), running(own.last(8, b"")).tolist(), None
        for own in map(Message, group.all(4)):
            kinds = ("node", "way", "relation")
            members = [(kinds[k], ref, strings[role]) for role, ref, k in zip(own.numbers(8).tolist(), running(own.last(9, b"")).tolist(), own.numbers(10).tolist(), strict=True)]
            yield "relation", own.last(1), None, None, tags(own), None, members


def _dense(own: Message, strings: list[str], place, lat0: int, lon0: int) -> Iterator[tuple]:
    """Nodes kept as columns. Their tags are one list: places of keys and values, and a 0 after each node's."""
    ids, lats, lons = (running(own.last(k)) for k in (1, 8, 9))
    flat = own.numbers(10).astype(np.int64)
    ends = np.flatnonzero(flat == 0) if len(flat) else np.zeros(len(ids), np.int64)
    begins = np.concatenate([[0], ends[:-1] + 1]) if len(flat) else ends
    rows = zip(ids.tolist(), place(lats, lat0).tolist(), place(lons, lon0).tolist(), begins.tolist(), ends.tolist(), strict=True)
    for i, lat, lon, a, b in rows:
        yield "node", i, lat, lon, {strings[k]: strings[v] for k, v in flat[a:b].reshape(-1, 2).tolist()}, None, None


def register(spark: SparkSession) -> None:
    spark.dataSource.register(OsmSource)


def located_ways(rows: DataFrame) -> DataFrame:
    """way_id, tags, nodes (ref, lat_e7, lon_e7 in order) of elements; a way that lacks the place of any node, or has
    fewer than two, is left out whole. Nodes meet ways by an equi-join on their number."""
    ways, nodes = rows.where("type = 'way'"), rows.where("type = 'node'").select(F.col("id").alias("ref"), "lat_e7", "lon_e7")
    steps = ways.select(F.col("id").alias("way_id"), F.size("refs").alias("n"), F.posexplode("refs").alias("seq", "ref"))
    found = steps.join(nodes, "ref").groupBy("way_id", "n").agg(F.array_sort(F.collect_list(F.struct("seq", "ref", "lat_e7", "lon_e7"))).alias("nodes"))
    found = found.where((F.size("nodes") == F.col("n")) & (F.col("n") >= 2))
    shaped = F.transform("nodes", lambda p: F.struct(p["ref"].alias("ref"), p["lat_e7"].alias("lat_e7"), p["lon_e7"].alias("lon_e7")))
    return found.select("way_id", shaped.alias("nodes")).join(ways.select(F.col("id").alias("way_id"), "tags"), "way_id")


def rings_of(ways: list[list[int]]) -> list[list[int]] | None:
    """Closed rings of node numbers that ways make, laid end to end; None if an end meets no other."""
    meet, left, rings = defaultdict(list), set(), []
    for i, way in enumerate(ways):
        if way[0] == way[-1]:
            rings.append(list(way))
        else:
            left.add(i)
            meet[way[0]].append(i)
            meet[way[-1]].append(i)
    while left:
        ring = list(ways[min(left)])
        left.discard(min(left))
        while ring[0] != ring[-1]:
            following = next((i for i in meet[ring[-1]] if i in left), None)
            if following is None:
                return None
            left.discard(following)
            way = ways[following]
            ring += way[1:] if way[0] == ring[-1] else way[-2::-1]
        rings.append(ring)
    return rings


def nested(rings: list[list[int]], place: dict[int, tuple[float, float]]) -> list[tuple[int, list[int]]]:
    """(outer ring, its holes), by number: a ring inside an odd number of others is a hole of the one next outside it."""

    def holds(outer: list[int], inner: list[int]) -> bool:
        own = set(outer)
        x, y = place[next((n for n in inner if n not in own), inner[0])]
        p = np.array([place[n] for n in outer])
        (x0, y0), (x1, y1) = p[:-1].T, p[1:].T
        cross = (y0 > y) != (y1 > y)
        return bool(np.count_nonzero(x < x0[cross] + (y - y0[cross]) / (y1 - y0)[cross] * (x1 - x0)[cross]) % 2)

    around = [[j for j, outer in enumerate(rings) if j != i and holds(outer, ring)] for i, ring in enumerate(rings)]
    return [(i, [j for j in range(len(rings)) if i in around[j] and len(around[j]) == len(around[i]) + 1]) for i in range(len(rings)) if len(around[i]) % 2 == 0]


RING = "array<struct<x:double,y:double>>"


def areas(rows: DataFrame) -> DataFrame:
    """type, id, tags, part, ring, holes: a row for each outer ring of closed ways and multipolygons, in degrees.

    A closed way of four points or more is an area if it has tags and no area=no. A relation of type multipolygon or
    boundary is put together from its ways, which need no tags themselves; one that lacks a way, or the place of a
    node, or whose ways do not close, is left out whole. Which rings are holes follows from where they lie, not from
    their roles. Ways meet relations and nodes by equi-joins; one relation's ways are put together in one task.
    """
    tag = lambda k: F.coalesce(F.try_element_at("tags", F.lit(k)), F.lit(""))
    place = lambda p: F.struct((p["lon_e7"] * 1e-7).alias("x"), (p["lat_e7"] * 1e-7).alias("y"))
    relations = rows.where((F.col("type") == "relation") & tag("type").isin("multipolygon", "boundary"))
    members = relations.select("id", F.expr("filter(members, m -> m.type = 'way')").alias("ways")).where(F.size("ways") > 0)
    members = members.select("id", F.size("ways").alias("n"), F.posexplode("ways").alias("seq", "m")).select("id", "n", "seq", F.col("m.ref").alias("way_id"))
    closed = rows.where((F.col("type") == "way") & (F.size("refs") >= 4) & (F.element_at("refs", 1) == F.element_at("refs", -1)) & (F.size("tags") > 0) & (tag("area") != "no"))
    nodes = rows.where("type = 'node'")
    own = located_ways(closed.unionByName(nodes)).select(F.lit("way").alias("type"), F.col("way_id").alias("id"), "tags", F.lit(0).alias("part"), F.transform("nodes", place).alias("ring"), F.array().cast(f"array<{RING}>").alias("holes"))
    wanted = rows.where("type = 'way'").join(members.select(F.col("way_id").alias("id")).distinct(), "id", "left_semi")
    ways = located_ways(wanted.unionByName(nodes.select(*wanted.columns))).select("way_id", "nodes")
    parts = members.join(ways, "way_id").select("id", "n", "seq", F.transform("nodes", lambda p: F.struct(p["ref"].alias("ref"), (p["lon_e7"] * 1e-7).alias("x"), (p["lat_e7"] * 1e-7).alias("y"))).alias("nodes"))

    def put_together(table: pd.DataFrame) -> pd.DataFrame:
        out = pd.DataFrame({"id": pd.Series(dtype="int64"), "part": pd.Series(dtype="int32"), "ring": pd.Series(dtype=object), "holes": pd.Series(dtype=object)})
        if len(table) < table["n"].iloc[0]:
            return out
        table = table.sort_values("seq")
        at = {p["ref"]: (p["x"], p["y"]) for line in table["nodes"] for p in line}
        rings = rings_of([[p["ref"] for p in line] for line in table["nodes"]])
        if not rings or any(len(r) < 4 for r in rings):
            return out
        drawn = [[{"x": at[r][0], "y": at[r][1]} for r in ring] for ring in rings]
        found = nested(rings, at)
        return pd.DataFrame({"id": [table["id"].iloc[0]] * len(found), "part": range(len(found)), "ring": [drawn[i] for i, _ in found], "holes": [[drawn[j] for j in holes] for _, holes in found]})

    made = parts.groupBy("id").applyInPandas(put_together, f"id long, part int, ring {RING}, holes array<{RING}>")
    made = made.join(relations.select("id", "tags"), "id").select(F.lit("relation").alias("type"), "id", "tags", "part", "ring", "holes")
    return own.unionByName(made)


def hiking_routes(rows: DataFrame) -> DataFrame:
    """way_id, route_id, network, name, ref: ways of walking routes; a route without a network is a local one."""
    t = lambda k: F.try_element_at("tags", F.lit(k))
    routes = rows.where((F.col("type") == "relation") & (t("type") == "route") & t("route").isin("hiking", "foot", "walking"))
    own = routes.select(F.col("id").alias("route_id"), F.coalesce(t("network"), F.lit("lwn")).alias("network"), t("name").alias("name"), t("ref").alias("ref"), F.explode("members").alias("m"))
    return own.where("m.type = 'way'").select(F.col("m.ref").alias("way_id"), "route_id", "network", "name", "ref")


def named_peaks(rows: DataFrame) -> DataFrame:
    """id, lat_e7, lon_e7, name, ele of named peaks, hills and volcanoes."""
    t = lambda k: F.try_element_at("tags", F.lit(k))
    found = rows.where((F.col("type") == "node") & t("natural").isin("peak", "hill", "volcano") & t("name").isNotNull() & F.col("lat_e7").isNotNull())
    return found.select("id", "lat_e7", "lon_e7", t("name").alias("name"), t("ele").alias("ele"))
