"""Rasters in long form (r, c, v), row 0 southmost; a missing cell is no data. Neighbours meet by equi-joins."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import geo


def neighbours(grid: DataFrame, offsets: list[tuple[int, int]]) -> DataFrame:
    """r, c, near: for each cell that any of its neighbours points to, the map (dr * 16 + dc) -> v of those there are.

    Each cell is sent to the cells that have it as a neighbour, so one sum by cell gathers all of them.
    """
    sends = F.array(*(F.struct(F.lit(dr).alias("dr"), F.lit(dc).alias("dc")) for dr, dc in offsets))
    sent = grid.select("r", "c", "v", F.explode(sends).alias("o"))
    key = F.col("o.dr") * 16 + F.col("o.dc")
    return sent.select((F.col("r") - F.col("o.dr")).alias("r"), (F.col("c") - F.col("o.dc")).alias("c"), key.alias("k"), "v").groupBy("r", "c").agg(F.map_from_entries(F.collect_list(F.struct("k", "v"))).alias("near"))


RING = [(dr, dc) for dr in (-1, 0, 1) for dc in (-1, 0, 1) if (dr, dc) != (0, 0)]


def _at(dr: int, dc: int) -> Column:
    return F.try_element_at(F.col("near"), F.lit(dr * 16 + dc))


def gradients(grid: DataFrame, cell: float) -> DataFrame:
    """r, c, gx, gy of cells with all eight neighbours: Horn's weighted differences, east and north."""
    rows = neighbours(grid.select("r", "c", F.col("v").cast("double").alias("v")), RING)
    rows = rows.join(grid.select("r", "c"), ["r", "c"], "left_semi").where(F.size("near") == 8)
    gx = (_at(-1, 1) + 2 * _at(0, 1) + _at(1, 1)) - (_at(-1, -1) + 2 * _at(0, -1) + _at(1, -1))
    gy = (_at(1, -1) + 2 * _at(1, 0) + _at(1, 1)) - (_at(-1, -1) + 2 * _at(-1, 0) + _at(-1, 1))
    return rows.select("r", "c", (gx / (8 * cell)).alias("gx"), (gy / (8 * cell)).alias("gy"))


def slope(grid: DataFrame, cell: float) -> DataFrame:
    """r, c, slope in quarter degrees."""
    return gradients(grid, cell).select("r", "c", F.rint(F.degrees(F.atan(F.hypot("gx", "gy"))) * 4).cast("int").alias("slope"))


def hillshade(grid: DataFrame, cell: float, azimuth: float = 315.0, altitude: float = 45.0) -> DataFrame:
    """r, c, shade: light on the ground less that on the level, in 1/127 (below 0: shadow)."""
    a, h = np.radians(azimuth), np.radians(altitude)
    lx, ly, lz = float(np.sin(a) * np.cos(h)), float(np.cos(a) * np.cos(h)), float(np.sin(h))
    light = (-F.col("gx") * lx - F.col("gy") * ly + lz) / F.sqrt(1 + F.col("gx") * F.col("gx") + F.col("gy") * F.col("gy"))
    return gradients(grid, cell).select("r", "c", F.rint((light - lz) * 127).cast("int").alias("shade"))


# From what slope (degrees) a band holds, its colour and opacity; the shade's colour and opacities.
BANDS = ((25.0, (0.99, 0.72, 0.45), 0.32), (30.0, (0.93, 0.42, 0.42), 0.45), (38.0, (0.84, 0.24, 0.46), 0.62), (45.0, (0.70, 0.09, 0.38), 0.80))
SHADOW, SHADOW_COLOUR, LIGHT = 0.30, (0.20, 0.22, 0.28), 0.20


def _unit(x: Column) -> Column:
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), x))


def slope_colour(quarter_degrees: Column, soft: float = 0.35) -> Column:
    """Struct (r, g, b, a), premultiplied, of a slope: the band that it is in alone, blending over a soft edge."""
    rgba = [F.lit(0.0)] * 4
    for start, colour, opacity in BANDS:
        t = _unit((quarter_degrees / 4 - start + soft) / (2 * soft))
        rgba = [old * (1 - t) + t * (opacity * c) for old, c in zip(rgba, (*colour, 1.0), strict=True)]
    return F.struct(*(x.alias(n) for x, n in zip(rgba, "rgba", strict=True)))


def shade_colour(shade: Column) -> Column:
    """Struct (r, g, b, a), premultiplied, of a shade in 1/127: the shadow's colour, and white light over it."""
    dark, light = _unit(-shade / 127) * SHADOW, _unit(shade / 127) * LIGHT
    rgb = [dark * c * (1 - light) + light for c in SHADOW_COLOUR]
    return F.struct(*(x.alias(n) for x, n in zip([*rgb, light + dark * (1 - light)], "rgba", strict=True)))


def shown(pixels: DataFrame) -> DataFrame:
    """Tiles (tile, with pixels' opacity a) on which anything is to be seen."""
    return pixels.groupBy("tile").agg(F.max("a").alias("most")).where(F.col("most") >= 1 / 255).select("tile")


def core(grid: DataFrame, half: int, least: float = 0.5, share: float = 0.5) -> DataFrame:
    """Cells (r, c) of at least ``least`` that have ``share`` of the highest within ``half`` cells, along both axes."""
    steps = F.sequence(F.lit(-half), F.lit(half))
    rows = grid.withColumn("d", F.explode(steps)).select("r", (F.col("c") + F.col("d")).alias("c"), "v").groupBy("r", "c").agg(F.max("v").alias("m"))
    rows = rows.withColumn("d", F.explode(steps)).select((F.col("r") + F.col("d")).alias("r"), "c", "m").groupBy("r", "c").agg(F.max("m").alias("m"))
    return grid.join(rows, ["r", "c"]).where((F.col("v") >= least) & (F.col("v") >= share * F.col("m"))).select("r", "c")


def distances(mask: np.ndarray) -> np.ndarray:
    """Each cell's distance from the nearest cell of a mask, exact, by one pass along each axis."""
    big = float(sum(mask.shape)) ** 2
    near = np.full(mask.shape, big)
    rows = np.arange(mask.shape[0])[:, None]
    above = np.maximum.accumulate(np.where(mask, rows, -(10**9)), axis=0)
    below = np.minimum.accumulate(np.where(mask, rows, 10**9)[::-1], axis=0)[::-1]
    up = np.minimum(np.minimum(rows - above, below - rows).astype(float), big) ** 2
    cols = np.arange(mask.shape[1])
    for c in cols:
        near[:, c] = (up + (cols - c) ** 2).min(axis=1)
    return np.sqrt(near)


def block_mean(grid: DataFrame, factor: int = 2) -> DataFrame:
    """r, c, v: means of blocks of cells, no data left out."""
    key = lambda x: F.floor(F.col(x) / factor).cast("int").alias(x)
    return grid.groupBy(key("r"), key("c")).agg(F.avg("v").alias("v"))


def pyramid(grid: DataFrame, levels: int) -> DataFrame:
    """level, r, c, v: the grid's means at each of the levels above it."""
    out, rows = None, grid
    for level in range(1, levels + 1):
        rows = block_mean(rows)
        part = rows.select(F.lit(level).alias("level"), "r", "c", "v")
        out = part if out is None else out.unionByName(part)
    return out


def steepest(grid: DataFrame, factor: int = 2) -> DataFrame:
    """r, c, v: the highest of a block instead of its mean; blocks with nothing above 0 have no row."""
    key = lambda x: F.floor(F.col(x) / factor).cast("int").alias(x)
    return grid.groupBy(key("r"), key("c")).agg(F.max("v").alias("v")).where("v > 0")


def mask_edge(mask: DataFrame) -> DataFrame:
    """Cells (r, c) of a mask with any of their four neighbours outside it."""
    side = [(-1, 0), (1, 0), (0, -1), (0, 1)]
    near = neighbours(mask.select("r", "c", F.lit(1).alias("v")), side)
    return mask.select("r", "c").join(near, ["r", "c"], "left").where(F.coalesce(F.size("near"), F.lit(0)) < 4).select("r", "c")


def lowest_around(grid: DataFrame) -> DataFrame:
    """r, c, v: the least of each cell and its eight neighbours."""
    near = neighbours(grid, [*RING, (0, 0)])
    return grid.select("r", "c").join(near, ["r", "c"]).select("r", "c", F.array_min(F.map_values("near")).alias("v"))


def bilinear(points: DataFrame, grid: DataFrame) -> DataFrame:
    """(id, v): the grid at points (id, x, y) in cells, from the four cells round each; null unless all four are there."""
    fx, fy = F.floor("x"), F.floor("y")
    corner = [(dr, dc) for dr in (0, 1) for dc in (0, 1)]
    weight = lambda dr, dc: (F.col("y") - fy if dr else 1 - (F.col("y") - fy)) * (F.col("x") - fx if dc else 1 - (F.col("x") - fx))
    four = F.array(*(F.struct((fy + dr).cast("int").alias("r"), (fx + dc).cast("int").alias("c"), weight(dr, dc).alias("w")) for dr, dc in corner))
    met = points.select("id", F.explode(four).alias("k")).select("id", "k.*").join(grid, ["r", "c"])
    found = met.groupBy("id").agg(F.sum(F.col("w") * F.col("v")).alias("v"), F.count(F.lit(1)).alias("n")).where("n = 4").select("id", "v")
    return points.select("id").join(found, "id", "left")


def line_cells(lines: DataFrame, step: float) -> DataFrame:
    """Distinct cells (r, c) under lines (x0, y0, x1, y1, in cells), read every ``step`` cells and at both ends."""
    n = F.greatest(F.lit(1), F.ceil(F.hypot(F.col("x1") - F.col("x0"), F.col("y1") - F.col("y0")) / step)).cast("int")
    rows = lines.withColumn("n", n).withColumn("i", F.explode(F.sequence(F.lit(0), F.col("n"))))
    lerp = lambda a, b: F.floor(F.col(a) + (F.col(b) - F.col(a)) * F.col("i") / F.col("n")).cast("int")
    return rows.select(lerp("y0", "y1").alias("r"), lerp("x0", "x1").alias("c")).distinct()


def box_smooth(grid: DataFrame, half: int) -> DataFrame:
    """r, c, v: means over (2 * half + 1) squared cells, no data left out.

    Sums go along rows and then along columns, so a cell is sent 2 * (2 * half + 1) times, not that squared.
    """
    steps = F.sequence(F.lit(-half), F.lit(half))
    rows = grid.withColumn("d", F.explode(steps)).select("r", (F.col("c") + F.col("d")).alias("c"), "v").groupBy("r", "c").agg(F.sum("v").alias("s"), F.count("v").alias("n"))
    rows = rows.withColumn("d", F.explode(steps)).select((F.col("r") + F.col("d")).alias("r"), "c", "s", "n")
    return rows.groupBy("r", "c").agg((F.sum("s") / F.sum("n")).alias("v")).join(grid.select("r", "c"), ["r", "c"], "left_semi")


def contour_segments(grid: DataFrame, interval: float) -> DataFrame:
    """level, x0, y0, x1, y1: pieces of contours within the squares between cells, by marching squares.

    A square's four corners meet by their neighbours; saddles are cut by the mean of the corners.
    """
    square = neighbours(grid.select("r", "c", F.col("v").cast("double").alias("v")), [(0, 0), (0, 1), (1, 0), (1, 1)]).where(F.size("near") == 4)
    v = {"a": _at(0, 0), "b": _at(0, 1), "d": _at(1, 1), "e": _at(1, 0)}  # anticlockwise from the south-west
    rows = square.select("r", "c", *(x.alias(k) for k, x in v.items()))
    low, high = F.least("a", "b", "d", "e"), F.greatest("a", "b", "d", "e")
    first, last = F.floor(low / interval) + 1, F.floor(high / interval)
    rows = rows.where(first <= last).withColumn("level", F.explode(F.transform(F.sequence(first, last), lambda n: n * interval)))
    cross = {}
    for side, (p, q, dx, dy) in {"s": ("a", "b", None, 0.0), "e": ("b", "d", 1.0, None), "n": ("e", "d", None, 1.0), "w": ("a", "e", 0.0, None)}.items():
        t = (F.col("level") - F.col(p)) / F.nullif(F.col(q) - F.col(p), F.lit(0.0))
        cut = (F.col(p) < F.col("level")) != (F.col(q) < F.col("level"))
        x, y = (t if dx is None else F.lit(dx)), (t if dy is None else F.lit(dy))
        cross[side] = F.when(cut, F.struct((F.col("c") + x).alias("x"), (F.col("r") + y).alias("y")))
    rows = rows.select("level", (F.col("a") < F.col("level")).alias("low_a"), ((F.col("a") + F.col("b") + F.col("d") + F.col("e")) / 4 < F.col("level")).alias("low_m"), *(x.alias(k) for k, x in cross.items()))
    some = F.array_compact(F.array("s", "e", "n", "w"))
    same = F.col("low_a") == F.col("low_m")
    saddle = F.when(same, F.array(F.array("s", "e"), F.array("n", "w"))).otherwise(F.array(F.array("s", "w"), F.array("e", "n")))
    pairs = F.when(F.size(some) == 4, saddle).otherwise(F.array(some))
    rows = rows.select("level", F.explode(pairs).alias("p"))
    return rows.select("level", F.col("p")[0]["x"].alias("x0"), F.col("p")[0]["y"].alias("y0"), F.col("p")[1]["x"].alias("x1"), F.col("p")[1]["y"].alias("y1"))


def gaussian(values: np.ndarray, sigma: float, truncate: float = 4.0) -> np.ndarray:
    """A block smoothed by a separable Gaussian, edges mirrored about themselves."""
    half = int(truncate * sigma + 0.5)
    kernel = np.exp(-0.5 * (np.arange(-half, half + 1) / sigma) ** 2)
    kernel /= kernel.sum()
    for axis in (0, 1):
        pad = [(half, half) if i == axis else (0, 0) for i in (0, 1)]
        wide = np.pad(values, pad, mode="symmetric")
        values = sum(k * np.take(wide, range(i, i + values.shape[axis]), axis=axis) for i, k in enumerate(kernel))
    return values


def smoothed(grid: DataFrame, sigma: float, block: int = 256) -> DataFrame:
    """r, c, v smoothed by a Gaussian within blocks that overlap by its reach, so that blocks join without seams.

    A cell is sent to every block whose halo holds it; a block's cells are a bounded group. Cells without data take
    no part, weights being renewed over those there are.
    """
    half = int(4 * sigma + 0.5)
    span = lambda x: F.sequence(F.floor((F.col(x) - half) / block).cast("int"), F.floor((F.col(x) + half) / block).cast("int"))
    rows = grid.select("r", "c", F.col("v").cast("double").alias("v"), F.explode(span("r")).alias("br"), span("c").alias("bcs")).withColumn("bc", F.explode("bcs")).drop("bcs")

    def run(table: pd.DataFrame) -> pd.DataFrame:
        br, bc = int(table["br"].iloc[0]), int(table["bc"].iloc[0])
        size = block + 2 * half
        value, there = np.zeros((size, size)), np.zeros((size, size))
        r, c = table["r"].to_numpy() - br * block + half, table["c"].to_numpy() - bc * block + half
        value[r, c], there[r, c] = table["v"], 1.0
        top, weight = gaussian(value, sigma), gaussian(there, sigma)
        own = (r >= half) & (r < half + block) & (c >= half) & (c < half + block)
        return pd.DataFrame({"r": table["r"][own], "c": table["c"][own], "v": top[r[own], c[own]] / weight[r[own], c[own]]})

    return rows.groupBy("br", "bc").applyInPandas(run, "r int, c int, v double")


def painted(polygons: DataFrame) -> DataFrame:
    """r, c, v: cells (by their centres) of polygons (place, value, rings in cells: the first outer, then holes).

    Polygons are painted in the order of ``place``; the last that reaches a cell decides. A hole does not show what
    lies under it: its cells are cleared.

    Rows are filled between the places where edges cross them, so only edges and cells are moved, never a whole ring.
    """
    ring = F.col("ring")
    edges = F.transform(F.sequence(F.lit(2), F.size(ring)), lambda i: F.struct(F.element_at(ring, i - 1).alias("a"), F.element_at(ring, i).alias("b")))
    sides = polygons.select("place", "value", F.posexplode("rings").alias("hole", "ring")).where(F.size("ring") > 1).select("place", "value", "hole", F.explode(edges).alias("s"))
    ax, ay, bx, by = (F.col(f"s.{p}.{c}") for p in "ab" for c in "xy")
    low, high = (F.ceil(f(ay, by) - 0.5).cast("int") for f in (F.least, F.greatest))
    met = sides.where(low < high).withColumn("r", F.explode(F.sequence(low, high - 1)))
    met = met.select("place", "value", "hole", "r", ((bx - ax) * (F.col("r") + 0.5 - ay) / F.nullif(by - ay, F.lit(0.0)) + ax).alias("x"))
    rows = met.groupBy("place", "value", "hole", "r").agg(F.array_sort(F.collect_list("x")).alias("xs"))
    ends = lambda k: F.ceil(F.get("xs", k) - 0.5).cast("int")
    spans = F.transform(F.sequence(F.lit(0), F.size("xs") - 2, F.lit(2)), lambda k: F.struct(ends(k).alias("a"), ends(k + 1).alias("b")))
    rows = rows.where(F.size("xs") > 1).select("place", "value", "hole", "r", F.explode(spans).alias("s")).where("s.a < s.b")
    cells = rows.select("place", "value", "hole", "r", F.explode(F.sequence(F.col("s.a"), F.col("s.b") - 1)).alias("c"))
    inside = cells.groupBy("r", "c", "place", "value").agg(F.min("hole").alias("first"), F.max("hole").alias("last")).where("first = 0")
    top = inside.groupBy("r", "c").agg(F.max(F.struct("place", F.when(F.col("last") > 0, F.lit(0)).otherwise(F.col("value")).alias("v"))).alias("top"))
    return top.select("r", "c", F.col("top.v").alias("v")).where("v <> 0")


def blended(coarse: DataFrame, fine: DataFrame, half: int) -> DataFrame:
    """r, c, v of a coarse grid, with a finer source laid over it where there is one, fading towards its edges.

    The fine value's weight is the share of the cells round it, (2 * half + 1) squared, that the fine source has.
    """
    there = coarse.select("r", "c").join(fine.select("r", "c", F.lit(1.0).alias("one")), ["r", "c"], "left").select("r", "c", F.coalesce("one", F.lit(0.0)).alias("v"))
    weight = box_smooth(there, half).withColumnRenamed("v", "w")
    rows = coarse.join(fine.withColumnRenamed("v", "f"), ["r", "c"], "left").join(weight, ["r", "c"])
    return rows.select("r", "c", F.when(F.col("f").isNull(), F.col("v").cast("double")).otherwise(F.col("w") * F.col("f") + (1 - F.col("w")) * F.col("v")).alias("v"))


def thinned(mask: np.ndarray) -> np.ndarray:
    """A mask worn down to lines one cell wide (Zhang and Suen)."""
    grid = np.pad(mask.astype(bool), 1)
    ring = [(-1, 0), (-1, 1), (0, 1), (1, 1), (1, 0), (1, -1), (0, -1), (-1, -1)]
    while True:
        gone = 0
        for turn in (0, 1):
            n = [np.roll(grid, (-dr, -dc), (0, 1)) for dr, dc in ring]
            count = sum(x.astype(np.int8) for x in n)
            steps = sum((~a & b).astype(np.int8) for a, b in zip(n, n[1:] + n[:1], strict=True))
            a, b = ((n[0] & n[2] & n[4]), (n[2] & n[4] & n[6])) if turn == 0 else ((n[0] & n[2] & n[6]), (n[0] & n[4] & n[6]))
            out = grid & (count >= 2) & (count <= 6) & (steps == 1) & ~a & ~b
            gone += int(out.sum())
            grid &= ~out
        if not gone:
            return grid[1:-1, 1:-1]


def without_spurs(lines: np.ndarray, cells: int) -> np.ndarray:
    """Lines with their ends taken off, a cell at a time, ``cells`` times."""
    grid = np.pad(lines.astype(bool), 1)
    for _ in range(cells):
        count = sum(np.roll(grid, (dr, dc), (0, 1)).astype(np.int8) for dr, dc in RING)
        ends = grid & (count <= 1)
        if not ends.any():
            break
        grid &= ~ends
    return grid[1:-1, 1:-1]


def skeletons(mask: DataFrame, spur: int = 0) -> DataFrame:
    """tile, r, c of the middle lines of each tile's mask (tile, r, c); a tile is a bounded group."""

    def run(table: pd.DataFrame) -> pd.DataFrame:
        r0, c0 = table["r"].min(), table["c"].min()
        grid = np.zeros((table["r"].max() - r0 + 1, table["c"].max() - c0 + 1), bool)
        grid[table["r"] - r0, table["c"] - c0] = True
        r, c = np.nonzero(without_spurs(thinned(grid), spur))
        return pd.DataFrame({"tile": table["tile"].iloc[0], "r": (r + r0).astype("int32"), "c": (c + c0).astype("int32")})

    return mask.groupBy("tile").applyInPandas(run, "tile int, r int, c int")


def cell_links(cells: DataFrame) -> DataFrame:
    """(r, c, r2, c2): neighbouring cells, each pair once; a diagonal only where no way round its corner is there."""
    steps = F.array(*(F.struct(F.lit(dr).alias("dr"), F.lit(dc).alias("dc")) for dr, dc in ((0, 1), (1, 0), (1, 1), (1, -1))))
    rows = cells.select("r", "c").withColumn("s", F.explode(steps)).select("r", "c", (F.col("r") + F.col("s.dr")).alias("r2"), (F.col("c") + F.col("s.dc")).alias("c2"))
    there = lambda a, b: cells.select(F.col("r").alias(a), F.col("c").alias(b))
    rows = rows.join(there("r2", "c2"), ["r2", "c2"], "left_semi")
    straight = (F.col("r") == F.col("r2")) | (F.col("c") == F.col("c2"))
    slant = rows.where(~straight).join(there("r", "c2"), ["r", "c2"], "left_anti").join(there("r2", "c"), ["r2", "c"], "left_anti")
    return rows.where(straight).select("r", "c", "r2", "c2").unionByName(slant.select("r", "c", "r2", "c2"))
