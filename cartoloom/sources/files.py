"""Tiles in SQLite, grids in .npy, ASCII grids, paletted PNGs; tile, GeoPackage and region-graph writers.

Readers that need a local file (SQLite, memory-mapped grids) are data sources for paths that every executor can
open; texts and images come through ``binaryFile`` and are parsed in Arrow batches, so any file system will do.
Writers of one file (SQLite, a region's graph) take rows through ``toLocalIterator``, a partition at a time.
"""

from __future__ import annotations

import io
import json
import os
import re
import sqlite3
import struct
import zipfile
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from ..functions import shapes

CELLS = "r int, c int, v double"
ASCII_GRID = re.compile(r"\s*(ncols|nrows|xll(?:corner|center)|yll(?:corner|center)|cellsize|nodata_value)\s+(\S+)\s*", re.I)


class Zoom(InputPartition):
    def __init__(self, zoom: int, low: int, high: int):
        self.zoom, self.low, self.high = zoom, low, high


class MbtilesSource(DataSource):
    """spark.read.format("mbtiles").load(path): z, x, y (rows from the north), data; both layouts of the tables.

    One partition for each zoom and range of columns.
    """

    @classmethod
    def name(cls) -> str:
        return "mbtiles"

    def schema(self) -> str:
        return "z int, x int, y int, data binary"

    def reader(self, schema) -> DataSourceReader:
        return MbtilesReader(self.options["path"], int(self.options.get("columns", "1024")))


class MbtilesReader(DataSourceReader):
    def __init__(self, path: str, columns: int):
        self.path, self.columns = path.removeprefix("file:"), columns

    def _open(self) -> sqlite3.Connection:
        return sqlite3.connect(f"file:{self.path}?mode=ro", uri=True)

    def partitions(self) -> list[InputPartition]:
        with self._open() as db:
            found = db.execute("SELECT zoom_level, min(tile_column), max(tile_column) FROM tiles GROUP BY 1 ORDER BY 1").fetchall()
        return [Zoom(z, lo, min(hi, lo + self.columns - 1)) for z, a, hi in found for lo in range(a, hi + 1, self.columns)] or [Zoom(0, 0, -1)]

    def read(self, part: Zoom) -> Iterator[tuple]:
        with self._open() as db:
            for x, y, data in db.execute("SELECT tile_column, tile_row, tile_data FROM tiles WHERE zoom_level = ? AND tile_column BETWEEN ? AND ? ORDER BY 1, 2", (part.zoom, part.low, part.high)):
                yield part.zoom, x, (1 << part.zoom) - 1 - y, data


class Rows(InputPartition):
    def __init__(self, low: int, high: int):
        self.low, self.high = low, high


class NpySource(DataSource):
    """spark.read.format("npy").option("nodata", n).load(path): r, c, v of a two-dimensional array, no data left out."""

    @classmethod
    def name(cls) -> str:
        return "npy"

    def schema(self) -> str:
        return CELLS

    def reader(self, schema) -> DataSourceReader:
        return NpyReader(self.options["path"], float(self.options.get("nodata", "nan")), int(self.options.get("rows", "256")))


class NpyReader(DataSourceReader):
    def __init__(self, path: str, nodata: float, rows: int):
        self.path, self.nodata, self.rows = path.removeprefix("file:"), nodata, rows

    def partitions(self) -> list[InputPartition]:
        n = np.load(self.path, mmap_mode="r").shape[0]
        return [Rows(lo, min(n, lo + self.rows)) for lo in range(0, n, self.rows)] or [Rows(0, 0)]

    def read(self, part: Rows) -> Iterator[pa.RecordBatch]:
        block = np.asarray(np.load(self.path, mmap_mode="r")[part.low : part.high], float)
        r, c = np.nonzero(~np.isnan(block) & (block != self.nodata))
        yield pa.RecordBatch.from_arrays([pa.array((r + part.low).astype(np.int32)), pa.array(c.astype(np.int32)), pa.array(block[r, c])], names=["r", "c", "v"])


# The grid that arrays without a layout beside them are on: metres across, and how 16-bit ones keep heights.
PLAIN_CRS, PLAIN_WIDTH, PLAIN_SOURCE = "EPSG:27700", 700_000, "OS Terrain 50"
LAYOUT = ("crs", "x0", "y0", "cell", "scale", "sea", "source", "smooth")


def layout_path(path: str) -> str:
    return f"{path.removesuffix('.npy')}.grid.json"


def layout_of(path: str) -> dict:
    """The grid that an .npy file is on: rows, columns and LAYOUT, from the file beside it, or else the plain grid's."""
    array = np.load(path, mmap_mode="r")
    found = {"rows": array.shape[0], "columns": array.shape[1], "scale": 1.0, "sea": 0.0, "source": "", "smooth": 0.0}
    beside = layout_path(path)
    if os.path.exists(beside):
        with open(beside) as f:
            return found | json.load(f)
    packed = array.dtype == np.int16
    return found | {"crs": PLAIN_CRS, "x0": 0, "y0": 0, "cell": PLAIN_WIDTH / array.shape[1], "scale": 0.1 if packed else 1.0, "sea": -25 if packed else -2.5, "source": PLAIN_SOURCE}


def write_layout(path: str, layout: dict) -> None:
    """Writes a grid's layout beside its .npy file."""

    def write(part: str) -> None:
        with open(part, "w") as f:
            json.dump({k: layout[k] for k in LAYOUT}, f)

    _published(layout_path(path), write)


def register(spark: SparkSession) -> None:
    for source in (MbtilesSource, NpySource):
        spark.dataSource.register(source)


def parse_ascii_grid(text: str, sea: float = 0.0) -> tuple[dict[str, float], np.ndarray]:
    """Header and values of an ASCII grid, row 0 southmost; no data becomes ``sea``."""
    head, at = {}, 0
    while m := ASCII_GRID.match(text, at):
        head[m[1].lower()] = float(m[2])
        at = m.end()
    values = np.array(text[at:].split(), float).reshape(int(head["nrows"]), int(head["ncols"]))[::-1]
    return head, np.where(values == head.get("nodata_value", np.nan), sea, values)


def _texts(content: bytes, name: str) -> Iterator[str]:
    """Grids of a file, or of zips within zips."""
    if content[:2] == b"PK":
        with zipfile.ZipFile(io.BytesIO(content)) as z:
            for inner in sorted(z.namelist()):
                if inner.lower().endswith((".asc", ".zip")):
                    yield from _texts(z.read(inner), inner)
    elif name.lower().endswith((".asc", ".txt")):
        yield content.decode()


def cells_of_ascii_grid(files: DataFrame, sea: float = 0.0) -> DataFrame:
    """r, c, v of the grids in files (path, content, as binaryFile reads them), placed by their corners in cells."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path, content in zip(batch["path"], batch["content"], strict=True):
                for text in _texts(content, path):
                    head, grid = parse_ascii_grid(text, sea)
                    r, c = np.indices(grid.shape)
                    corner = [round((head.get(f"{k}llcorner", head.get(f"{k}llcenter", 0.0))) / head["cellsize"]) for k in "yx"]
                    yield pd.DataFrame({"r": (r + corner[0]).ravel().astype("int32"), "c": (c + corner[1]).ravel().astype("int32"), "v": grid.ravel()})

    return files.select("path", "content").mapInPandas(run, CELLS)


def read_heat_png(data: bytes) -> np.ndarray:
    """Palette indices of an 8-bit paletted PNG; any other kind is an error."""
    if data[:8] != b"\x89PNG\r\n\x1a\n":
        raise ValueError("not a PNG")
    at, packed, head = 8, b"", None
    while at < len(data):
        size, kind = struct.unpack_from(">I4s", data, at)
        body = data[at + 8 : at + 8 + size]
        at += 12 + size
        if kind == b"IHDR":
            head = struct.unpack(">IIBBBBB", body)
        elif kind == b"IDAT":
            packed += body
    if head is None or head[2:4] != (8, 3) or head[6]:
        raise ValueError("not an 8-bit paletted image")
    width, height = head[:2]
    raw = np.frombuffer(zlib.decompress(packed), np.uint8).reshape(height, width + 1)
    out = np.zeros((height + 1, width + 1), np.int32)
    for y in range(height):
        line, up, how = raw[y, 1:].astype(np.int32), out[y], int(raw[y, 0])
        row = out[y + 1]
        if how == 0:
            row[1:] = line
        elif how == 1:
            row[1:] = np.cumsum(line) & 255
        elif how == 2:
            row[1:] = (line + up[1:]) & 255
        else:
            for x in range(width):
                a, b, c = int(row[x]), int(up[x + 1]), int(up[x])
                if how == 3:
                    guess = (a + b) >> 1
                else:
                    p = a + b - c
                    guess = min((abs(p - a), 0, a), (abs(p - b), 1, b), (abs(p - c), 2, c))[2]
                row[x + 1] = (int(line[x]) + guess) & 255
    return out[1:, 1:].astype(np.uint8)


def cells_of_heat_png(tiles: DataFrame) -> DataFrame:
    """tx, ty, px, py, heat of heat tiles (x, y, data), cells without heat left out."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for x, y, data in zip(batch["x"], batch["y"], batch["data"], strict=True):
                grid = read_heat_png(data)
                py, px = np.nonzero(grid)
                yield pd.DataFrame({"tx": x, "ty": y, "px": px.astype("int32"), "py": py.astype("int32"), "heat": grid[py, px].astype("int16")})

    return tiles.select("x", "y", "data").mapInPandas(run, "tx int, ty int, px int, py int, heat short")


def _published(path: str, write) -> None:
    """Writes beside the path and renames, so that no half of a file is ever found there."""
    part = f"{path}.part"
    if os.path.exists(part):
        os.remove(part)
    write(part)
    os.replace(part, path)


def write_mbtiles(places: DataFrame, contents: DataFrame, path: str, metadata: dict[str, str]) -> None:
    """A tile file of places (z, x, y from the north, data_id) and contents (data_id, data), each content once."""

    def write(part: str) -> None:
        with sqlite3.connect(part) as db:
            db.executescript(
                "CREATE TABLE metadata (name TEXT, value TEXT); CREATE TABLE tiles_data (tile_data_id INTEGER PRIMARY KEY, tile_data BLOB);"
                "CREATE TABLE tiles_shallow (zoom_level INTEGER, tile_column INTEGER, tile_row INTEGER, tile_data_id INTEGER, PRIMARY KEY (zoom_level, tile_column, tile_row)) WITHOUT ROWID;"
                "CREATE VIEW tiles AS SELECT zoom_level, tile_column, tile_row, tile_data FROM tiles_shallow JOIN tiles_data USING (tile_data_id);"
            )
            db.executemany("INSERT INTO metadata VALUES (?, ?)", metadata.items())
            db.executemany("INSERT INTO tiles_data VALUES (?, ?)", ((r["data_id"], bytes(r["data"])) for r in contents.toLocalIterator()))
            db.executemany("INSERT INTO tiles_shallow VALUES (?, ?, ?, ?)", ((r["z"], r["x"], (1 << r["z"]) - 1 - r["y"], r["data_id"]) for r in places.toLocalIterator()))
        db.close()

    _published(path, write)


def write_geopackage(lines: DataFrame, path: str, layer: str, srs: int = 4326) -> None:
    """A layer of lines (column ``line``) with the other columns as attributes."""
    names = [c for c in lines.columns if c != "line"]
    box = lines.select(F.explode("line").alias("p")).agg(F.min("p.x"), F.min("p.y"), F.max("p.x"), F.max("p.y")).first()

    def write(part: str) -> None:
        with sqlite3.connect(part) as db:
            db.executescript(
                "PRAGMA application_id = 1196444487; CREATE TABLE gpkg_spatial_ref_sys (srs_name TEXT, srs_id INTEGER PRIMARY KEY, organization TEXT, organization_coordsys_id INTEGER, definition TEXT);"
                "CREATE TABLE gpkg_contents (table_name TEXT PRIMARY KEY, data_type TEXT, identifier TEXT, min_x DOUBLE, min_y DOUBLE, max_x DOUBLE, max_y DOUBLE, srs_id INTEGER);"
                "CREATE TABLE gpkg_geometry_columns (table_name TEXT, column_name TEXT, geometry_type_name TEXT, srs_id INTEGER, z INTEGER, m INTEGER);"
            )
            db.execute("INSERT INTO gpkg_spatial_ref_sys VALUES ('WGS 84', ?, 'EPSG', ?, 'undefined')", (srs, srs))
            db.execute("INSERT INTO gpkg_contents VALUES (?, 'features', ?, ?, ?, ?, ?, ?)", (layer, layer, *box, srs))
            db.execute("INSERT INTO gpkg_geometry_columns VALUES (?, 'geom', 'LINESTRING', ?, 0, 0)", (layer, srs))
            db.execute(f'CREATE TABLE "{layer}" (fid INTEGER PRIMARY KEY, geom BLOB, {", ".join(f"{chr(34)}{n}{chr(34)}" for n in names)})')
            marks = ", ".join("?" * (len(names) + 1))
            rows = ((shapes.geopackage_blob(np.array([(p["x"], p["y"]) for p in r["line"]]), srs), *(r[n] for n in names)) for r in lines.toLocalIterator())
            db.executemany(f'INSERT INTO "{layer}" (geom, {", ".join(f"{chr(34)}{n}{chr(34)}" for n in names)}) VALUES ({marks})', rows)
        db.close()

    _published(path, write)


# What a region's network begins with, and the version of its layout.
REGION_MARK, REGION_VERSION = 0x52474D4D, 1


def write_region_graph(edges: pd.DataFrame, nodes: pd.DataFrame, magic: int = REGION_MARK, version: int = REGION_VERSION) -> bytes:
    """A region's network as one block: a head of 16 numbers, then little-endian sections, each padded to eight bytes.

    nodes: lat_e7, lon_e7 in order; edges: u, v (places of nodes), length, cost_f, cost_b. Sections: latitudes,
    longitudes, starts of the adjacency, its entries (an edge, or its complement at its far end), u, v, lengths, costs.
    """
    n, m = len(nodes), len(edges)
    u, v = edges["u"].to_numpy(np.int32), edges["v"].to_numpy(np.int32)
    at, entry = np.concatenate([u, v]), np.concatenate([np.arange(m), ~np.arange(m)]).astype("<i4")
    order = np.argsort(at, kind="stable")
    start = np.concatenate([[0], np.cumsum(np.bincount(at, minlength=n))]).astype("<i4")
    sections = [nodes["lat_e7"].to_numpy("<i4"), nodes["lon_e7"].to_numpy("<i4"), start, entry[order], u.astype("<i4"), v.astype("<i4"), *(edges[c].to_numpy("<f4") for c in ("length", "cost_f", "cost_b"))]
    out = struct.pack("<16i", magic, version, n, m, len(sections), *[0] * 11)
    for s in sections:
        out += s.tobytes() + b"\0" * (-s.nbytes % 8)
    return out
