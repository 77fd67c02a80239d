"""Numeric rules: heat levels, costs, quantising and the scores of climbs."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the score of a climb.
LIFT, MIDDLE, RATE = 1.1, 30.0, 0.45
THIRDS = (3.0, 2.0, 1.0)
EARTH = 6_371_000.0
CLIMB_COST = 8.0


def heat_level(heat: Column) -> Column:
    """Heat in half octaves: 0, or the rounded power of two, 255 at most."""
    level = F.rint(F.pow(F.lit(2.0), F.rint(F.log2(F.greatest(heat, F.lit(1.0))) * 2) / 2))
    return F.when(heat > 0, F.least(F.lit(255.0), level)).otherwise(F.lit(0.0)).cast("int")


def up_to(metres: Column, step: int) -> Column:
    """Metres rounded up to a step; 0 for unknown."""
    return F.coalesce(F.ceil(metres / step).cast("long") * step, F.lit(0).cast("long"))


def size_extra(spaces: Column) -> Column:
    """Metres that a small car park counts as farther away; of unknown size as with 10 spaces."""
    return F.lit(1500.0) / F.sqrt(F.when(spaces > 0, spaces).otherwise(F.lit(10)))


def jut(height: Column, distance: Column) -> Column:
    h = F.greatest(height, F.lit(0.0))
    return h * h / F.greatest(F.hypot(h, distance), F.lit(1e-9))


def jut_of(height: np.ndarray, distance: np.ndarray) -> np.ndarray:
    """jut of arrays; heights above 0."""
    return height * height / np.maximum(np.sqrt(height * height + distance * distance), 1e-9)


def boost(steepness: Column) -> Column:
    return 1 + F.lit(LIFT) / (1 + F.exp(-F.lit(RATE) * (steepness - MIDDLE)))


def steepness(height: Column, first: Column, second: Column, third: Column) -> Column:
    """Angle of a third of the height over the mean distance of the thirds, the lower ones counting more."""
    mean = (first * THIRDS[0] + second * THIRDS[1] + third * THIRDS[2]) / sum(THIRDS)
    return F.degrees(F.atan2(height / 3, mean))


def score(height: Column, distance: Column, steep: Column) -> Column:
    return jut(height, distance) * boost(steep)


def horizon_drop(distance: Column) -> Column:
    """How far the ground falls below the horizontal, by the curve of the earth."""
    return distance * distance / (2 * EARTH)


def edge_cost(length: Column, factor: Column, climb: Column) -> Column:
    """Cost of an edge in one direction; infinite where the factor is."""
    inf = F.lit(float("inf"))
    return F.when(factor == inf, inf).otherwise(length * factor + climb * CLIMB_COST).cast("float")


def path_metres(distance: Column, cap: int = 5000) -> Column:
    """Metres to a path, rounded to tens (halves to even), at most ``cap``."""
    return F.least(F.rint(distance / 10).cast("int") * 10, F.lit(cap))


def decimetres(metres: Column) -> Column:
    return F.greatest(F.lit(-32767.0), F.least(F.lit(32767.0), F.rint(metres * 10))).cast("short")


def even_opacity(alpha: Column) -> Column:
    """An opacity of 0 .. 255 in steps of two."""
    return F.rint(alpha / 2).cast("int") * 2


def lake_class(area_ha: Column) -> Column:
    """0 below a hectare, 1 from one, 2 from ten, 3 from fifty."""
    return F.when(area_ha >= 50, 3).when(area_ha >= 10, 2).when(area_ha >= 1, 1).otherwise(0)
