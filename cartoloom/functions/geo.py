"""Geometry and projections as Column expressions."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

EARTH_MEAN = 6_371_008.8
#: Metres of a degree of longitude at the equator, and of latitude.
EAST, NORTH = 111_320.0, 110_574.0
#: GRS80.
AXIS, FLATTENING = 6_378_137.0, 1 / 298.257222101


def segment_length(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Metres between points in 1e-7 degrees, on the plane at their middle latitude."""
    k = math.pi / 180 * 1e-7 * EARTH_MEAN
    middle = F.cos(F.radians((lat1 + lat2) / 2 * 1e-7))
    return F.hypot((lon2 - lon1) * middle * k, (lat2 - lat1) * k)


def local_metres(lat: Column, lon: Column, lat0: float) -> tuple[Column, Column]:
    return lon * (EAST * math.cos(math.radians(lat0))), lat * NORTH


def ring_area(ring: Column) -> Column:
    """Signed area of a ring of structs (x, y): positive if it runs anticlockwise."""
    n = F.size(ring)
    shifted = F.concat(F.slice(ring, 2, F.greatest(n - 1, F.lit(0))), F.slice(ring, 1, 1))
    terms = F.zip_with(ring, shifted, lambda a, b: a["x"] * b["y"] - b["x"] * a["y"])
    return F.aggregate(terms, F.lit(0.0), lambda s, v: s + v) / 2


def ring_centroid(ring: Column) -> tuple[Column, Column]:
    """Mean of a closed ring's corners, the closing one left out."""
    open_ring = F.slice(ring, 1, F.size(ring) - 1)
    mean = lambda c: F.aggregate(open_ring, F.lit(0.0), lambda s, p: s + p[c]) / F.size(open_ring)
    return mean("x"), mean("y")


def tile_x(lon: Column, zoom: Column | int) -> Column:
    return F.floor((lon + 180) / 360 * F.pow(F.lit(2.0), _col(zoom))).cast("int")


def tile_y(lat: Column, zoom: Column | int) -> Column:
    """Row of a tile, counted from the north."""
    return F.floor((1 - F.asinh(F.tan(F.radians(lat))) / math.pi) / 2 * F.pow(F.lit(2.0), _col(zoom))).cast("int")


def tms_flip(y: Column, zoom: Column) -> Column:
    return (F.pow(F.lit(2.0), zoom) - 1 - y).cast("int")


def tile_west(x: Column, zoom: Column | int) -> Column:
    return x / F.pow(F.lit(2.0), _col(zoom)) * 360 - 180


def tile_north(y: Column, zoom: Column | int) -> Column:
    return F.degrees(F.atan(F.sinh(math.pi * (1 - 2 * y / F.pow(F.lit(2.0), _col(zoom))))))


def morton(lat_e7: Column, lon_e7: Column) -> Column:
    """Z-order of points, 16 bits an axis: near points get near numbers."""

    def spread(v: Column) -> Column:
        for shift, mask in ((8, 0x00FF00FF), (4, 0x0F0F0F0F), (2, 0x33333333), (1, 0x55555555)):
            v = v.bitwiseOR(F.shiftleft(v, shift)).bitwiseAND(F.lit(mask).cast("long"))
        return v

    y = F.shiftright(lat_e7.cast("long") + 900_000_000, 15).bitwiseAND(F.lit(0xFFFF).cast("long"))
    x = F.shiftright(lon_e7.cast("long") + 1_800_000_000, 16).bitwiseAND(F.lit(0xFFFF).cast("long"))
    return F.shiftleft(spread(y), 1).bitwiseOR(spread(x))


def to_grid(lat: Column, lon: Column, lon0: float, axis: float = AXIS, flattening: float = FLATTENING) -> tuple[Column, Column]:
    """Transverse Mercator (scale 1) by Krueger's series to the third order: metres east and north of (0, lon0)."""
    n = flattening / (2 - flattening)
    a = axis / (1 + n) * (1 + n**2 / 4 + n**4 / 64)
    alpha = (n / 2 - 2 * n**2 / 3 + 5 * n**3 / 16, 13 * n**2 / 48 - 3 * n**3 / 5, 61 * n**3 / 240)
    e = 2 * math.sqrt(n) / (1 + n)
    phi, lam = F.radians(lat), F.radians(lon - lon0)
    t = F.sinh(F.atanh(F.sin(phi)) - e * F.atanh(e * F.sin(phi)))
    xi, eta = F.atan2(t, F.cos(lam)), F.atanh(F.sin(lam) / F.sqrt(1 + t * t))
    north, east = xi, eta
    for j, c in enumerate(alpha, 1):
        north = north + c * F.sin(2 * j * xi) * F.cosh(2 * j * eta)
        east = east + c * F.cos(2 * j * xi) * F.sinh(2 * j * eta)
    return east * a, north * a


def grid_extent(areas: DataFrame, lon0: float, cell: float, points: int = 200, line: float = 10_000.0) -> DataFrame:
    """id, x0, y0, rows, cols of a grid over each area (id, west, south, east, north): its edge, which curves in the
    projection, is read at ``points`` a side; the corner lies on a whole ``line``."""
    k = F.col("k") / (points - 1)
    side = lambda a, b: F.col(a) + (F.col(b) - F.col(a)) * k
    edge = F.array(*(F.struct(x.alias("lon"), y.alias("lat")) for x, y in ((side("west", "east"), F.col("south")), (F.col("east"), side("south", "north")), (side("east", "west"), F.col("north")), (F.col("west"), side("north", "south")))))
    at = areas.withColumn("k", F.explode(F.sequence(F.lit(0), F.lit(points - 1)))).select("id", F.explode(edge).alias("p"))
    east, north = to_grid(F.col("p.lat"), F.col("p.lon"), lon0)
    found = at.select("id", east.alias("x"), north.alias("y")).groupBy("id").agg(*(f(c).alias(f"{f.__name__}{c}") for f in (F.min, F.max) for c in "xy"))
    low = lambda c: F.floor(F.col(f"min{c}") / line) * line
    count = lambda c: F.ceil((F.col(f"max{c}") - low(c)) / cell).cast("int")
    return found.select("id", low("x").alias("x0"), low("y").alias("y0"), count("y").alias("rows"), count("x").alias("cols"))


def in_ring(x: Column, y: Column, ring: Column) -> Column:
    """Whether a point lies in a closed ring of structs (x, y), by crossings of a ray."""
    edges = F.zip_with(F.slice(ring, 1, F.size(ring) - 1), F.slice(ring, 2, F.size(ring) - 1), lambda a, b: F.struct(a.alias("a"), b.alias("b")))
    crossing = F.filter(edges, lambda s: ((s["a"]["y"] > y) != (s["b"]["y"] > y)) & (x < (s["b"]["x"] - s["a"]["x"]) * (y - s["a"]["y"]) / F.nullif(s["b"]["y"] - s["a"]["y"], F.lit(0.0)) + s["a"]["x"]))
    return F.size(crossing) % 2 == 1


def _col(v: Column | int) -> Column:
    return v if isinstance(v, Column) else F.lit(v)
