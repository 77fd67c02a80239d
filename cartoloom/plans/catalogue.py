"""Collects the queries of all plan modules."""

from . import features, networks, places, publishing, rasters, sequences, tiling  # noqa: F401
from .base import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
