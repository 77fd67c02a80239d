"""Outlines: GeoJSON features, shapefiles, and the small text tables that go with them."""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

RING = "array<struct<x:double,y:double>>"


def geojson_regions(spark: SparkSession, path: str) -> DataFrame:
    """id, name, parent, rings (outer and hole rings of all polygons) of a feature collection."""
    ring = "array<array<array<double>>>"
    schema = "features array<struct<properties:struct<id:string,name:string,parent:string>,geometry:struct<type:string,coordinates:string>>>"
    f = spark.read.schema(schema).option("multiLine", True).json(path).select(F.explode("features").alias("f"))
    text = F.col("f.geometry.coordinates")
    polygons = F.when(F.col("f.geometry.type") == "Polygon", F.array(F.from_json(text, ring))).otherwise(F.from_json(text, f"array<{ring}>"))
    rings = F.transform(F.flatten(polygons), lambda r: F.transform(r, lambda p: F.struct(p[0].alias("x"), p[1].alias("y"))))
    return f.select("f.properties.id", "f.properties.name", "f.properties.parent", rings.alias("rings"))


def region_tree(features: DataFrame, top: str, top_name: str, countries: list[str], area: str) -> DataFrame:
    """place, id, name, parent, area, download: the whole first, then each country followed by its parts by name."""
    spark = features.sparkSession
    order = spark.createDataFrame([(c, i) for i, c in enumerate(countries)], "country string, at int")
    own = features.join(order, features.id == order.country).select("at", F.lit(0).alias("level"), "id", "name", F.lit(top).alias("parent"))
    parts = features.join(order, features.parent == order.country).select("at", F.lit(1).alias("level"), "id", "name", "parent")
    whole = spark.createDataFrame([(-1, 0, top, top_name, None)], "at int, level int, id string, name string, parent string")
    return whole.unionByName(own).unionByName(parts).withColumns({"area": F.lit(area), "download": F.lit(True)}).orderBy("at", "level", "name").drop("at", "level")


def parse_shapes(data: bytes, box: tuple[float, float, float, float] | None = None) -> Iterator[tuple[np.ndarray, bool]]:
    """(ring, is outer) of a shapefile's polygons that meet the box; outer rings run clockwise."""
    at = 100
    while at + 8 <= len(data):
        size = struct.unpack_from(">i", data, at + 4)[0] * 2
        body, at = data[at + 8 : at + 8 + size], at + 8 + size
        if struct.unpack_from("<i", body)[0] not in (5, 15, 25):
            continue
        x0, y0, x1, y1, parts, points = struct.unpack_from("<4d2i", body, 4)
        if box and (x1 < box[0] or x0 > box[2] or y1 < box[1] or y0 > box[3]):
            continue
        starts = [*struct.unpack_from(f"<{parts}i", body, 44), points]
        xy = np.frombuffer(body, "<f8", 2 * points, 44 + 4 * parts).reshape(-1, 2)
        for a, b in zip(starts[:-1], starts[1:], strict=True):
            ring = xy[a:b]
            yield ring, float(np.sum(ring[:-1, 0] * ring[1:, 1] - ring[1:, 0] * ring[:-1, 1])) < 0


def shapefile_rings(files: DataFrame, box: tuple[float, float, float, float] | None = None) -> DataFrame:
    """path, ring, outer of shapefiles (path, content, as binaryFile reads them)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path, content in zip(batch["path"], batch["content"], strict=True):
                found = list(parse_shapes(content, box))
                if not found:
                    continue
                yield pd.DataFrame({"path": path, "ring": [[{"x": x, "y": y} for x, y in r.tolist()] for r, _ in found], "outer": [o for _, o in found]})

    return files.select("path", "content").mapInPandas(run, f"path string, ring {RING}, outer boolean")


def car_parks(spark: SparkSession, path: str, box: tuple[float, float, float, float], most: int = 500) -> DataFrame:
    """key, lon, lat, spaces, path_m of a table of car parks, near a path and within the box."""
    rows = spark.read.schema("key string, lon double, lat double, spaces int, path_m int").option("sep", "\t").csv(path)
    return rows.where((F.col("path_m") <= most) & F.col("lon").between(box[0], box[2]) & F.col("lat").between(box[1], box[3]))


def path_metres(spark: SparkSession, path: str) -> DataFrame:
    """number, path_m of a table of "n123", "w456", "r789" and metres; the number is three times the id plus the type."""
    rows = spark.read.schema("key string, path_m int").option("sep", "\t").csv(path)
    return rows.select(F.expr("cast(substring(key, 2) as long) * 3 + instr('nwr', substring(key, 1, 1)) - 1").alias("number"), "path_m")


def poly_text(name: str, rings: list[list[tuple[float, float]]]) -> str:
    """Outlines in the Osmosis polygon filter format: a name, numbered rings, a point a line, and ends of rings and file."""
    lines = [name]
    for number, ring in enumerate(rings, start=1):
        lines.append(str(number))
        lines.extend(f"  {lon:.7f} {lat:.7f}" for lon, lat in ring)
        lines.append("END")
    return "\n".join([*lines, "END", ""])
