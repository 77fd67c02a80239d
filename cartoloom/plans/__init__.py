"""The catalogue of queries: each operator applied to the derived tables, with its SQL twin."""

from .catalogue import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
