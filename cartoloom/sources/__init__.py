"""Readers and writers of the file formats that Spark lacks."""

from .files import ASCII_GRID, MbtilesSource, NpySource, cells_of_ascii_grid, cells_of_heat_png, read_heat_png, register, write_geopackage, write_mbtiles, write_region_graph

__all__ = ["ASCII_GRID", "MbtilesSource", "NpySource", "cells_of_ascii_grid", "cells_of_heat_png", "read_heat_png", "register", "write_geopackage", "write_mbtiles", "write_region_graph"]
