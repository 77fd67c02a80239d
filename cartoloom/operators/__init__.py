"""Operators on DataFrames: sequences along ways, networks, places, rasters, tiles and publishing."""
