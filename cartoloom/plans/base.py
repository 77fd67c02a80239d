"""Registry of queries, and the tables derived from the test data that they run over."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

#: Portable SQL of the derived tables; names in braces are tables of the test data.
DERIVED = {
    "nodes": """SELECT p_partkey AS ref,
        CAST(540000000 + (p_partkey % 100) * 20000 + (p_partkey * 7919) % 9973 AS INT) AS lat_e7,
        CAST(-30000000 + (p_partkey % 211) * 30000 + (p_partkey * 104729) % 9967 AS INT) AS lon_e7,
        CAST((p_partkey * 7919) % 300 AS DOUBLE) AS ele FROM {part}""",
    "way_nodes": """SELECT l_orderkey AS way_id,
        CAST(row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_shipdate) - 1 AS INT) AS seq,
        l_partkey AS ref FROM {lineitem}""",
    "way_tags": """SELECT o_orderkey AS way_id,
        CASE o_orderkey % 9 WHEN 0 THEN 'path' WHEN 1 THEN 'footway' WHEN 2 THEN 'track' WHEN 3 THEN 'steps' WHEN 4 THEN 'residential'
            WHEN 5 THEN 'tertiary' WHEN 6 THEN 'primary' WHEN 7 THEN 'motorway' ELSE NULL END AS highway,
        CASE o_orderkey % 11 WHEN 0 THEN 'no' WHEN 1 THEN 'yes' WHEN 2 THEN 'designated' ELSE NULL END AS foot,
        CASE o_orderkey % 13 WHEN 0 THEN 'private' WHEN 1 THEN 'no' ELSE NULL END AS access,
        CASE o_orderkey % 7 WHEN 0 THEN 'public_footpath' WHEN 1 THEN 'restricted_byway' ELSE NULL END AS designation,
        CASE o_orderkey % 10 WHEN 0 THEN 'alpine_hiking' WHEN 1 THEN 'mountain_hiking' ELSE NULL END AS sac_scale,
        CASE o_orderkey % 8 WHEN 0 THEN '30 mph' WHEN 1 THEN 'GB:nsl_single' WHEN 2 THEN 'IT:rural' WHEN 3 THEN '50' WHEN 4 THEN 'walk' WHEN 5 THEN 'de:urban' ELSE NULL END AS maxspeed,
        CASE o_orderkey % 6 WHEN 0 THEN 'yes' WHEN 1 THEN '-1' WHEN 2 THEN 'no' ELSE NULL END AS oneway,
        CASE o_orderkey % 14 WHEN 3 THEN 'bad' ELSE NULL END AS trail_visibility,
        CASE o_orderkey % 12 WHEN 5 THEN 'both' ELSE NULL END AS sidewalk,
        CASE o_orderkey % 15 WHEN 4 THEN 'roundabout' ELSE NULL END AS junction,
        CASE o_orderkey % 17 WHEN 0 THEN 'ground' WHEN 1 THEN 'asphalt' ELSE NULL END AS surface,
        CASE o_orderkey % 19 WHEN 0 THEN 'sidewalk' ELSE NULL END AS footway
        FROM {orders}""",
    "heat_samples": """SELECT user_id AS way_id, CAST(row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS INT) AS seq,
        CASE WHEN event_type = 'error' THEN CAST(0 AS DOUBLE) WHEN value > 255 THEN CAST(255 AS DOUBLE) ELSE value END AS heat FROM {events}""",
    "peaks": """SELECT c_custkey AS id, CAST((c_custkey * 7919) % 40009 AS DOUBLE) AS e, CAST((c_custkey * 104729) % 40013 AS DOUBLE) AS n,
        c_acctbal AS score, CASE WHEN c_custkey % 17 = 0 THEN -1 ELSE c_nationkey END AS county FROM {customer}""",
    "parks": """SELECT s_suppkey AS id, CAST((s_suppkey * 6101) % 40009 AS DOUBLE) AS e, CAST((s_suppkey * 3571) % 40013 AS DOUBLE) AS n,
        CASE WHEN s_suppkey % 4 = 0 THEN NULL ELSE CAST(1 + (s_suppkey * 37) % 120 AS INT) END AS spaces FROM {supplier}""",
    "counties": """SELECT n_nationkey AS id, CAST((n_nationkey % 5) * 8000 AS DOUBLE) AS x0, CAST(((n_nationkey - n_nationkey % 5) / 5) * 8000 AS DOUBLE) AS y0,
        CAST((n_nationkey % 5) * 8000 + 8500 AS DOUBLE) AS x1, CAST(((n_nationkey - n_nationkey % 5) / 5) * 8000 + 8500 AS DOUBLE) AS y1 FROM {nation}""",
    "raster": """SELECT CAST(l_orderkey % 64 AS INT) AS r, CAST(l_partkey % 64 AS INT) AS c, CAST(max(l_quantity) * 10 AS INT) AS v
        FROM {lineitem} WHERE ((l_orderkey % 64) * 7 + l_partkey % 64) % 31 <> 0 GROUP BY l_orderkey % 64, l_partkey % 64""",
    "tiles_a": """SELECT CAST(8 + doc_id % 7 AS INT) AS z, CAST(doc_id % 97 AS INT) AS x, CAST(doc_id % 89 AS INT) AS y, text AS data FROM {documents}""",
    "tiles_b": """SELECT CAST(8 + (page_id * 5) % 7 AS INT) AS z, CAST((page_id * 5) % 97 AS INT) AS x, CAST((page_id * 5) % 89 AS INT) AS y, html AS data FROM {pages}""",
}
TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def derived(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    sql = DERIVED[name]
    return spark.sql(sql, **{t: table(spark, sf_dir, t) for t in TABLES if f"{{{t}}}" in sql})


def with_tables(names: str, body: str) -> str:
    """DuckDB SQL of ``body`` over derived tables (names parted by spaces)."""
    parts = [f"{n} AS ({DERIVED[n].format(**{t: t for t in TABLES})})" for n in names.split()]
    body = body.strip()
    if body.upper().startswith("WITH "):
        return f"WITH {', '.join(parts)}, {body[5:]}"
    return f"WITH {', '.join(parts)} {body}"


def query(needs: str, sql: str | None):
    """Registers a query under its function's name; ``sql`` is its twin over the derived tables it needs."""

    def register(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLES[f.__name__] = with_tables(needs, sql) if needs else sql
        return f

    return register
