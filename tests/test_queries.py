"""Every query with SQL against DuckDB over the smallest tables, row by row."""

import glob
import math
import os

import duckdb
import pytest

from cartoloom import plans

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for path in glob.glob(f"{SMALL}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return con


def plain(v):
    if v is None or isinstance(v, float) and math.isnan(v):
        return None
    return round(v, 6) if isinstance(v, float) else v


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), sorted(str([plain(r[i]) for i in order]) for r in rows)


@pytest.mark.parametrize("name", sorted(plans.ORACLES))
def test_same_rows_as_sql(spark, duck, name):
    df = plans.QUERIES[name](spark, SMALL)
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    cur = duck.execute(plans.ORACLES[name])
    assert got == rows_of([d[0] for d in cur.description], cur.fetchall())


#: Least and most rows over the smallest tables, and a column whose values repeat nowhere, of queries without SQL. What
#: their rows should be is tested against plain searches and known values in test_kernels and test_whole_network.
WITHOUT_SQL = {
    "strong_components": ("node", lambda r: r.root <= r.node),
    "park_walks": (None, lambda r: 0 < r.metres <= 60_000 and 2 * r.shared <= 0.4 * r.metres),
    "round_walks": ("e", lambda r: 0 < r.metres <= 1_000_000),
    "best_walks": ("e", lambda r: 0 < r.walk <= 1_000_000),
    "contours": (None, lambda r: all(v is not None and math.isfinite(v) for v in r if isinstance(v, float))),
    "gaussian_smooth": (None, lambda r: all(v is None or math.isfinite(v) for v in r if isinstance(v, float))),
    "grid_projection": (None, lambda r: all(v is not None for v in r)),
    "skeleton": (None, lambda r: all(v is not None for v in r)),
}


@pytest.mark.parametrize("name", sorted(set(plans.QUERIES) - set(plans.ORACLES)))
def test_rows_without_sql(spark, name):
    key, holds = WITHOUT_SQL[name]
    rows = plans.QUERIES[name](spark, SMALL).collect()
    assert rows and all(map(holds, rows))
    assert key is None or len({r[key] for r in rows}) == len(rows)


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
