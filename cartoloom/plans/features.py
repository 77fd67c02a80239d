"""Queries of tag classifiers and of parsers of mapped texts."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import tags as t
from .base import derived, query, table

_WALK_SQL = """CASE WHEN b IS NULL OR coalesce(foot IN ('no','private','use_sidepath'), false) OR (coalesce(access IN ('no','private'), false) AND NOT coalesce(foot IN ('yes','designated','permissive'), false)) THEN NULL
  ELSE (CASE WHEN designation IS NOT NULL THEN 1.0 WHEN b > 1.3 AND (coalesce(sidewalk = 'both', false) OR coalesce(foot = 'designated', false)) THEN 1.3 ELSE b END)
    * (CASE WHEN sac_scale = 'alpine_hiking' THEN 2.0 ELSE 1.0 END) * (CASE WHEN trail_visibility = 'bad' THEN 1.5 ELSE 1.0 END) END"""
WALK_CTE = f"""walk AS (SELECT *, CAST({_WALK_SQL} AS DOUBLE) AS factor FROM (SELECT *, CASE highway WHEN 'path' THEN 1.0 WHEN 'footway' THEN 1.0 WHEN 'track' THEN 1.0
  WHEN 'steps' THEN 1.2 WHEN 'residential' THEN 1.25 WHEN 'tertiary' THEN 1.6 WHEN 'primary' THEN 3.0 END AS b FROM way_tags))"""


def walk_column():
    c = F.col
    return t.walk_factor(c("highway"), c("foot"), c("access"), c("designation"), c("sac_scale"), c("trail_visibility"), c("sidewalk"))


def _thousandths(column):
    return F.round(column * 1000).cast("long")


@query("way_tags", f"WITH {WALK_CTE} SELECT way_id, CAST(round(factor * 1000) AS BIGINT) AS factor_k FROM walk")
def walk_factor(spark, sf_dir):
    return derived(spark, sf_dir, "way_tags").select("way_id", _thousandths(walk_column()).alias("factor_k"))


@query(
    "way_tags",
    """WITH s AS (SELECT *, CASE highway WHEN 'residential' THEN 30 WHEN 'tertiary' THEN 50 WHEN 'primary' THEN 70 WHEN 'motorway' THEN 110 END AS speed,
      CASE maxspeed WHEN '30 mph' THEN 30 * 1.609 WHEN 'GB:nsl_single' THEN 96 WHEN 'IT:rural' THEN 90 WHEN '50' THEN 50 WHEN 'de:urban' THEN 50 END AS lim FROM way_tags),
    f AS (SELECT *, 110 / greatest(CASE WHEN lim IS NULL THEN speed ELSE least(speed, lim * 0.9) END, 5) AS f FROM s WHERE speed IS NOT NULL AND access IS NULL)
    SELECT way_id, CASE WHEN oneway = '-1' THEN -1 ELSE CAST(round(f * 1000) AS BIGINT) END AS fwd_k,
      CASE WHEN oneway = '-1' THEN CAST(round(f * 1000) AS BIGINT) WHEN oneway = 'yes' OR (coalesce(oneway, '') <> 'no' AND (coalesce(junction, '') = 'roundabout' OR highway = 'motorway')) THEN -1 ELSE CAST(round(f * 1000) AS BIGINT) END AS back_k FROM f""",
)
def drive_factor(spark, sf_dir):
    c = F.col
    f = t.drive_factors(c("highway"), c("maxspeed"), c("oneway"), access=c("access"), junction=c("junction"))
    rows = derived(spark, sf_dir, "way_tags").select("way_id", f.alias("f")).where("f IS NOT NULL")
    shown = lambda x: F.when(c(x) == float("inf"), F.lit(-1).cast("long")).otherwise(_thousandths(c(x)))
    return rows.select("way_id", shown("f.fwd").alias("fwd_k"), shown("f.back").alias("back_k"))


@query(
    "way_tags",
    f"""WITH {WALK_CTE} SELECT way_id, coalesce(surface = 'ground', false) OR highway = 'track' OR coalesce(designation = 'restricted_byway', false) OR sac_scale IS NOT NULL OR trail_visibility IS NOT NULL AS away
    FROM walk WHERE highway IN ('path','footway','track','steps') AND footway IS NULL AND factor IS NOT NULL""",
)
def walk_path(spark, sf_dir):
    c = F.col
    away = t.walk_path(c("highway"), c("footway"), c("surface"), c("designation"), c("sac_scale"), c("trail_visibility"), F.lit(None).cast("string"), walk_column())
    return derived(spark, sf_dir, "way_tags").select("way_id", away.alias("away")).where("away IS NOT NULL")


@query("", """SELECT p_partkey, CASE WHEN p_size % 7 = 0 OR p_size % 5 = 1 THEN 2 WHEN p_size % 5 = 0 THEN 1 END AS land FROM part""")
def land_class(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    leisure = F.when(p.p_size % 7 == 0, F.lit("park")).when(p.p_size % 7 == 1, F.lit("pitch"))
    landuse = F.when(p.p_size % 5 == 0, F.lit("retail")).when(p.p_size % 5 == 1, F.lit("meadow")).when(p.p_size % 5 == 2, F.lit("quarry"))
    return p.select("p_partkey", t.land_class(leisure, landuse, F.lit("water")).alias("land"))


@query(
    "way_tags",
    """SELECT way_id, CASE designation WHEN 'public_footpath' THEN 'footpath' ELSE designation END AS row_kind, CASE sac_scale WHEN 'alpine_hiking' THEN 4 WHEN 'mountain_hiking' THEN 2 END AS sac,
      NOT coalesce(foot IN ('yes','designated'), false) AND (coalesce(foot = 'no', false) OR access IS NOT NULL) AS private,
      CASE WHEN designation IS NOT NULL OR highway = 'track' THEN 12 ELSE 13 END AS min_zoom FROM way_tags WHERE highway IS NOT NULL""",
)
def row_sac_private(spark, sf_dir):
    c = F.col
    row = t.right_of_way(c("designation"))
    return derived(spark, sf_dir, "way_tags").where("highway IS NOT NULL").select(
        "way_id", row.alias("row_kind"), t.sac_grade(c("sac_scale")).alias("sac"), t.is_private(c("foot"), c("access")).alias("private"), t.zoom_of_trail(row, c("highway")).alias("min_zoom")
    )


_PARK_SQL = """p AS (SELECT p_partkey AS id, CASE p_size % 6 WHEN 0 THEN 'multi-storey' WHEN 1 THEN 'underground' WHEN 2 THEN 'lane' WHEN 3 THEN 'garages' WHEN 4 THEN 'layby' END AS parking,
  CASE p_partkey % 9 WHEN 0 THEN 'private' WHEN 1 THEN 'customers' END AS access, CASE p_partkey % 5 WHEN 0 THEN '~' || CAST(p_size AS VARCHAR) || ' or so' WHEN 1 THEN '0' END AS capacity,
  CASE p_partkey % 4 WHEN 0 THEN CAST(1 + p_partkey % 6 AS VARCHAR) END AS levels, CASE p_partkey % 7 WHEN 0 THEN ' Yes ' WHEN 1 THEN 'Mo-Sa 08:00-18:00' WHEN 2 THEN 'free' WHEN 3 THEN 'what' END AS fee_text,
  CASE p_partkey % 2 WHEN 0 THEN 'some' END AS charge, p_retailprice AS area FROM {part}),
q AS (SELECT *, CASE WHEN p_capacity > 0 THEN p_capacity END AS mapped, CASE WHEN parking = 'lane' THEN 14.0 WHEN parking = 'multi-storey' THEN coalesce(26.0 / CAST(levels AS INT), 6.0)
  WHEN parking = 'underground' THEN coalesce(26.0 / CAST(levels AS INT), 12.0) ELSE 24.0 END AS per FROM (SELECT *, CASE WHEN capacity LIKE '~%' THEN CAST(replace(substr(capacity, 2), ' or so', '') AS INT) ELSE 0 END AS p_capacity FROM p))"""


def _parks(spark, sf_dir):
    first = _PARK_SQL.split("\nq AS")[0].removeprefix("p AS (").rstrip(",").rstrip(")").replace("VARCHAR", "STRING")
    return spark.sql(first, part=table(spark, sf_dir, "part"))


@query(
    "",
    "WITH " + _PARK_SQL.format(part="part") + """ SELECT id, coalesce(mapped, CAST(greatest(1, floor(area / per + 0.5)) AS INT)) AS spaces, CASE WHEN mapped IS NULL THEN 1 END AS est,
      CASE WHEN fee_text IS NULL THEN CASE WHEN charge IS NOT NULL THEN 'yes' END WHEN fee_text = ' Yes ' THEN 'yes' WHEN fee_text LIKE 'Mo%' THEN 'times' WHEN fee_text = 'free' THEN 'no' END AS fee,
      CASE WHEN access = 'customers' THEN 'customers' END AS access, CASE parking WHEN 'lane' THEN 'street_side' ELSE parking END AS kind,
      -least(coalesce(mapped, CAST(greatest(1, floor(area / per + 0.5)) AS INT)), 100000) AS sort_key
    FROM q WHERE coalesce(parking, '') <> 'garages' AND coalesce(access, '') <> 'private'""",
)
def parking_feature(spark, sf_dir):
    c = F.col
    f = t.parking_feature(c("parking"), c("access"), c("capacity"), c("levels"), c("fee_text"), c("charge"), c("area"))
    return _parks(spark, sf_dir).select("id", f.alias("f")).where("f IS NOT NULL").select("id", "f.*")


@query(
    "",
    "WITH " + _PARK_SQL.format(part="part") + " SELECT id, coalesce(mapped, CAST(greatest(1, round_even(area / per, 0)) AS INT)) AS spaces FROM q WHERE coalesce(parking, '') <> 'garages' AND access IS NULL",
)
def walk_start_spaces(spark, sf_dir):
    c = F.col
    n = t.start_spaces(c("parking"), c("access"), c("capacity"), c("levels"), c("area"))
    return _parks(spark, sf_dir).select("id", n.alias("spaces")).where("spaces IS NOT NULL")


@query(
    "way_tags",
    "SELECT way_id, CASE maxspeed WHEN '30 mph' THEN 48270 WHEN 'GB:nsl_single' THEN 96000 WHEN 'IT:rural' THEN 90000 WHEN '50' THEN 50000 WHEN 'de:urban' THEN 50000 END AS limit_m FROM way_tags",
)
def speed_limit_parse(spark, sf_dir):
    return derived(spark, sf_dir, "way_tags").select("way_id", F.round(t.speed_limit(F.col("maxspeed")) * 1000).cast("int").alias("limit_m"))


@query(
    "",
    """SELECT p_partkey, CASE WHEN p_partkey % 6 = 3 THEN NULL ELSE nullif(p_size % 50, 0) END AS n FROM part""",
)
def count_parse(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    n = (p.p_size % 50).cast("string")
    text = F.element_at(F.array(n, F.concat(F.lit("~"), n), F.concat(F.lit(" c. "), n, F.lit("+")), F.concat(F.lit("about "), n), F.concat(F.lit("approx "), n), F.concat(F.lit("ca."), n, F.lit("-ish"))), (p.p_partkey % 6 + 1).cast("int"))
    return p.select("p_partkey", t.count_of(text).alias("n"))


@query(
    "",
    """SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN p_size WHEN 1 THEN CAST(round_even(p_size + 0.5, 0) AS INT) WHEN 2 THEN CAST(round_even(p_size * 0.3048, 0) AS INT) END AS even_m,
      CASE p_partkey % 4 WHEN 0 THEN p_size WHEN 1 THEN p_size + 1 WHEN 2 THEN CAST(floor(p_size * 0.3048 + 0.5) AS INT) END AS up_m FROM part""",
)
def height_parse(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    n = p.p_size.cast("string")
    text = F.element_at(F.array(n, F.concat(n, F.lit(".5 m")), F.concat(n, F.lit(" ft ")), F.concat(n, F.lit(" yd"))), (p.p_partkey % 4 + 1).cast("int"))
    return p.select("p_partkey", t.metres_of(text).alias("even_m"), t.metres_of(text, half_up=True).alias("up_m"))


@query(
    "",
    """SELECT p_partkey, CASE p_partkey % 3 WHEN 0 THEN 'A' || CAST(p_size AS VARCHAR) || ' / B1' || chr(10) || p_name WHEN 1 THEN chr(10) || p_name ELSE '' END AS label FROM part""",
)
def road_label(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    ref = F.when(p.p_partkey % 3 == 0, F.concat(F.lit(" A"), p.p_size.cast("string"), F.lit(";; B1 "))).when(p.p_partkey % 3 == 1, F.lit(" ;"))
    name = F.when(p.p_partkey % 3 != 2, F.concat(F.lit(" "), p.p_name, F.lit(" ")))
    return p.select("p_partkey", t.road_label(ref, name).alias("label"))


@query(
    "way_tags",
    """SELECT way_id, (CASE highway WHEN 'residential' THEN 13 WHEN 'tertiary' THEN 9 WHEN 'primary' THEN 5 WHEN 'motorway' THEN 1 END) | (CASE WHEN junction = 'roundabout' THEN 32 ELSE 0 END) AS kind,
      CAST(way_id % 1000 AS INT) | (((CASE highway WHEN 'residential' THEN 13 WHEN 'tertiary' THEN 9 WHEN 'primary' THEN 5 WHEN 'motorway' THEN 1 END) | (CASE WHEN junction = 'roundabout' THEN 32 ELSE 0 END)) << 24) AS word
    FROM way_tags WHERE highway IN ('residential','tertiary','primary','motorway')""",
)
def road_kind_bits(spark, sf_dir):
    c = F.col
    rows = derived(spark, sf_dir, "way_tags").withColumn("kind", t.road_kind(c("highway"), c("junction"), F.lit(None).cast("string"))).where("kind IS NOT NULL")
    return rows.select("way_id", "kind", t.road_word((c("way_id") % 1000).cast("int"), c("kind")).alias("word"))


@query(
    "",
    """WITH f AS (SELECT p_partkey AS id, CASE WHEN p_size % 3 = 0 THEN 'parking' END AS amenity, CASE WHEN p_size % 2 = 0 THEN p_name END AS name, CASE WHEN p_size % 5 = 0 THEN 'waterfall' END AS waterway,
      CASE p_size % 4 WHEN 0 THEN 'peak' WHEN 1 THEN 'valley' END AS nat, p_partkey % 2 = 0 AS pt, CASE p_size % 7 WHEN 0 THEN 'path' WHEN 1 THEN 'primary' END AS highway, CASE WHEN p_size % 11 = 0 THEN 'byway' END AS des FROM part),
    l AS (SELECT id, CASE WHEN amenity IS NOT NULL THEN 'parking' WHEN name IS NOT NULL AND waterway IS NOT NULL THEN 'waterfall' WHEN name IS NOT NULL AND pt AND coalesce(nat, '') = 'peak' THEN 'peak'
      WHEN name IS NOT NULL AND coalesce(nat, '') = 'valley' THEN 'valley' WHEN NOT pt AND (coalesce(highway, '') = 'path' OR (highway IS NOT NULL AND des IS NOT NULL)) THEN 'trail' END AS layer FROM f)
    SELECT id, layer FROM l WHERE layer IS NOT NULL""",
)
def feature_layers(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    s = p.p_size
    layer = t.layer_of(
        F.when(s % 3 == 0, F.lit("parking")), F.when(s % 2 == 0, p.p_name), F.when(s % 5 == 0, F.lit("waterfall")), F.when(s % 4 == 0, F.lit("peak")).when(s % 4 == 1, F.lit("valley")),
        p.p_partkey % 2 == 0, F.when(s % 7 == 0, F.lit("path")).when(s % 7 == 1, F.lit("primary")), F.when(s % 11 == 0, F.lit("byway")),
    )
    return p.select(p.p_partkey.alias("id"), layer.alias("layer")).where("layer IS NOT NULL")


@query(
    "",
    """SELECT p_partkey AS id FROM part WHERE (p_size % 4 <> 1) AND p_size % 6 <> 0 AND p_size % 9 <> 0 AND p_retailprice * 20 >= 10000""",
)
def lake_filter(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    s = p.p_size
    water = F.when(s % 4 == 0, F.lit("lake")).when(s % 4 == 1, F.lit("river")).when(s % 4 == 2, F.lit("lake;pond"))
    return p.where(t.is_lake(water, F.when(s % 6 == 0, F.lit("canal")), F.when(s % 9 == 0, F.lit("yes")), p.p_retailprice * 20)).select(p.p_partkey.alias("id"))
