"""Classifiers of tagged map features as Column expressions.

Every function takes the Columns of the tags it reads (null: the tag is missing), so the same rule serves a flat
table, a struct or a map of tags.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Factors, speeds and tag lists of the rules.
WALK_BASE = {
    "path": 1.0, "footway": 1.0, "bridleway": 1.0, "track": 1.0, "steps": 1.2, "pedestrian": 1.05, "cycleway": 1.15, "living_street": 1.2,
    "residential": 1.25, "service": 1.25, "unclassified": 1.3, "road": 1.3, "tertiary": 1.6, "tertiary_link": 1.6, "secondary": 2.2,
    "secondary_link": 2.2, "primary": 3.0, "primary_link": 3.0, "trunk": 5.0, "trunk_link": 5.0,
}
SAC_FACTOR = {"demanding_mountain_hiking": 1.2, "alpine_hiking": 2.0, "demanding_alpine_hiking": 4.0, "difficult_alpine_hiking": 6.0}
SAC_GRADE = {"mountain_hiking": 2, "demanding_mountain_hiking": 3, "alpine_hiking": 4, "demanding_alpine_hiking": 5, "difficult_alpine_hiking": 6}
RIGHTS_OF_WAY = {
    "public_footpath": "footpath", "public_bridleway": "bridleway", "restricted_byway": "restricted_byway",
    "byway_open_to_all_traffic": "byway", "public_byway": "byway", "byway": "byway",
}
DRIVE_KMH, FERRY_KMH, SLOWEST_KMH = 110.0, 20.0, 5.0
DRIVE_SPEED = {
    "motorway": 110, "motorway_link": 60, "trunk": 90, "trunk_link": 50, "primary": 70, "primary_link": 45, "secondary": 60, "secondary_link": 40,
    "tertiary": 50, "tertiary_link": 35, "unclassified": 40, "road": 30, "residential": 30, "living_street": 10, "service": 15,
}
NATIONAL_LIMITS = {"gb:nsl_single": 96, "uk:nsl_single": 96, "national": 96, "gb:nsl_dual": 112, "uk:nsl_dual": 112, "gb:motorway": 112, "uk:motorway": 112}
ZONE_LIMITS = {
    "rural": {"it": 90, "no": 80, "at": 100, "ch": 80, "de": 100, "fr": 80, "si": 90, "li": 80, "mc": 50},
    "trunk": {"it": 110, "ch": 100, "si": 110, "fr": 110},
    "motorway": {"it": 130, "no": 110, "at": 130, "ch": 120, "de": 130, "fr": 130, "si": 130},
}
NO_CARS = ("no", "private", "agricultural", "forestry", "delivery", "emergency")
ROAD_KINDS = (
    "", "motorway", "motorway_link", "trunk", "trunk_link", "primary", "primary_link", "secondary", "secondary_link", "tertiary",
    "tertiary_link", "unclassified", "road", "residential", "living_street", "service", "ferry",
)
ROUNDABOUT_BIT = 0x20
# Patterns of counts and of heights with their units.
COUNT = r"^\s*(?:~|c\.|ca\.|approx\.?)?\s*(\d+)(?:[^\n]*)$"
HEIGHT = r"^\s*(-?\d+(?:\.\d+)?)\s*(m|ft|feet|')?\s*$"
FOOT_PATHS = ("path", "footway", "bridleway", "track", "steps", "cycleway")
PAVEMENTS = ("sidewalk", "crossing", "traffic_island", "access_aisle")
UNPAVED = (
    "unpaved", "ground", "dirt", "earth", "grass", "gravel", "fine_gravel", "compacted", "mud", "sand", "woodchips", "pebblestone", "rock",
    "stone", "grass_paver", "shells", "clay", "soil",
)
OFF_ROAD = ("public_bridleway", "restricted_byway", "byway_open_to_all_traffic", "public_byway", "byway")
BUILT_UP = ("residential", "commercial", "retail", "industrial", "garages", "construction", "railway", "education", "institutional", "depot", "port")
GREEN_LEISURE = ("park", "nature_reserve", "common")
GREEN_LANDUSE = ("forest", "recreation_ground", "village_green", "meadow")
GREEN_NATURAL = ("wood", "heath", "moor", "scrub", "grassland", "fell", "wetland", "beach", "sand", "bare_rock")
TOWN, GREEN, CANAL = 1, 2, 3
CLOSED = ("private", "no", "residents", "staff", "employees", "permit", "delivery", "disabled", "emergency", "military", "agricultural", "forestry")
GARAGES = ("garage_boxes", "garages", "garage", "carports", "sheds")
STREET_PARKING = ("street_side", "lane", "on_kerb", "half_on_kerb", "shoulder")
OWN_PARKING = ("multi-storey", "underground", "rooftop", "layby")
FEE_NO, FEE_DONATION = ("no", "free", "none"), ("donation", "donations")
FEE_YES = ("yes", "paid", "pay", "pay_and_display", "pay_and_display;pay_on_exit", "pay_on_exit", "ticket")
LAKES = ("lake", "pond", "reservoir", "lagoon", "oxbow", "mere", "fishpond", "lake;pond", "dew_pond")


def lookup(table: dict, key: Column, kind: str) -> Column:
    """The entry of a literal table, or null."""
    literal = F.create_map(*(F.lit(x) for kv in table.items() for x in kv))
    return F.try_element_at(literal, key).cast(kind)


def _is(column: Column, *values: str) -> Column:
    """False where the tag is missing."""
    return F.coalesce(column.isin(*values), F.lit(False))


def walk_factor(highway, foot=None, access=None, designation=None, sac_scale=None, trail_visibility=None, sidewalk=None, area=None, indoor=None) -> Column:
    """Walking factor of a way, the same both ways; null if walkers may not or cannot use it."""
    none = F.lit(None).cast("string")
    foot, access, designation, sac, seen, sidewalk, area, indoor = (none if c is None else c for c in (foot, access, designation, sac_scale, trail_visibility, sidewalk, area, indoor))
    base = lookup(WALK_BASE, highway, "double")
    barred = _is(area, "yes") | _is(indoor, "yes") | _is(foot, "no", "private", "use_sidepath") | (_is(access, "no", "private") & ~_is(foot, "yes", "designated", "permissive"))
    eased = F.when(_is(designation, *RIGHTS_OF_WAY), F.lit(1.0)).when((base > 1.3) & (_is(sidewalk, "both", "left", "right", "yes") | _is(foot, "designated")), F.lit(1.3)).otherwise(base)
    factor = eased * F.coalesce(lookup(SAC_FACTOR, sac, "double"), F.lit(1.0)) * F.when(_is(seen, "bad", "horrible", "no"), 1.5).otherwise(1.0)
    return F.when(base.isNotNull() & ~barred, factor)


def speed_limit(maxspeed: Column) -> Column:
    """Speed limit in km/h of a mapped text: national codes, country zones, miles or a number; null if unreadable."""
    text = F.lower(F.trim(F.coalesce(maxspeed, F.lit(""))))
    country = F.substring_index(text, ":", 1)
    zone = F.regexp_extract(text, r"^[^:]*:(.*)$", 1)
    zones = F.coalesce(*(F.when(zone == z, lookup(t, country, "double")) for z, t in ZONE_LIMITS.items()))
    number = F.when(text.endswith("mph"), F.regexp_replace(text, r"\s*mph$", "").try_cast("double") * 1.609).otherwise(text.try_cast("double"))
    finite = F.when(~F.isnan(number) & (F.abs(number) != float("inf")), number)
    return F.coalesce(lookup(NATIONAL_LIMITS, text, "double"), F.when(zone == "urban", F.lit(50.0)).when(zone.isin(*ZONE_LIMITS), zones).otherwise(finite))


def drive_factors(highway, maxspeed, oneway, access=None, motorcar=None, motor_vehicle=None, vehicle=None, service=None, junction=None, route=None, area=None) -> Column:
    """Struct (fwd, back) of driving factors, infinite where a car may not go that way; null if cars cannot use it."""
    none = F.lit(None).cast("string")
    access, motorcar, motor, vehicle, service, junction, route, area = (none if c is None else c for c in (access, motorcar, motor_vehicle, vehicle, service, junction, route, area))
    car = F.coalesce(*(F.when(c != "", c) for c in (motorcar, motor, vehicle)))
    speed = lookup(DRIVE_SPEED, highway, "double")
    limit = speed_limit(maxspeed)
    slowed = F.when(limit != 0, F.least(speed, limit * 0.9)).otherwise(speed)
    f = F.lit(DRIVE_KMH) / F.greatest(slowed, F.lit(SLOWEST_KMH))
    barred = _is(area, "yes") | _is(service, "driveway", "emergency_access") | _is(car, *NO_CARS) | (car.isNull() & _is(access, *NO_CARS))
    ahead = _is(oneway, "yes", "true", "1") | (~_is(oneway, "no") & (_is(junction, "roundabout", "circular") | _is(highway, "motorway", "motorway_link")))
    inf, ferry = F.lit(float("inf")), F.lit(DRIVE_KMH / FERRY_KMH)
    both = lambda x, y: F.struct(x.alias("fwd"), y.alias("back"))
    road = F.when(speed.isNotNull() & ~barred, F.when(_is(oneway, "-1"), both(inf, f)).when(ahead, both(f, inf)).otherwise(both(f, f)))
    return F.when(_is(route, "ferry"), F.when(_is(motorcar, "yes") | _is(motor, "yes"), both(ferry, ferry))).otherwise(road)


def walk_path(highway, footway, surface, designation, sac_scale, trail_visibility, towpath, factor: Column) -> Column:
    """null: no path for walkers; else whether its own tags say that it is away from towns."""
    usable = _is(highway, *FOOT_PATHS) & ~_is(footway, *PAVEMENTS) & factor.isNotNull()
    away = _is(surface, *UNPAVED) | _is(highway, "track", "bridleway") | _is(designation, *OFF_ROAD) | sac_scale.isNotNull() | trail_visibility.isNotNull() | _is(towpath, "yes")
    return F.when(usable, away)


def land_class(leisure, landuse, natural) -> Column:
    """GREEN before TOWN, or null."""
    return F.when(_is(leisure, *GREEN_LEISURE) | _is(landuse, *GREEN_LANDUSE) | _is(natural, *GREEN_NATURAL), F.lit(GREEN)).when(_is(landuse, *BUILT_UP), F.lit(TOWN))


def count_of(text: Column) -> Column:
    """Whole number that a tag begins with, after a word for "about" if need be; null without one, at zero, or beyond six digits."""
    digits = F.regexp_extract(F.coalesce(text, F.lit("")), COUNT, 1)
    return F.nullif(F.when(F.length(digits).between(1, 6), digits.try_cast("int")), F.lit(0))


def metres_of(text: Column, half_up: bool = False) -> Column:
    """A height in whole metres from "978", "978.4 m", "3209 ft" or "3209'"; halves go to even, or up."""
    value, unit = (F.regexp_extract(F.coalesce(text, F.lit("")), HEIGHT, group) for group in (1, 2))
    value = value.try_cast("double")
    metres = F.when(unit.isin("ft", "feet", "'"), value * 0.3048).otherwise(value)
    return (F.floor(metres + 0.5) if half_up else F.rint(metres)).cast("int")


def _area_per_space(kind: Column, levels: Column) -> Column:
    floor = F.lit(26.0) / levels
    return F.when(_is(kind, *STREET_PARKING), F.lit(14.0)).when(_is(kind, "multi-storey"), F.coalesce(floor, F.lit(6.0))).when(_is(kind, "underground"), F.coalesce(floor, F.lit(12.0))).otherwise(F.lit(24.0))


def start_spaces(parking, access, capacity, levels, area: Column) -> Column:
    """Spaces of a car park a walk may start from: mapped, else by its area, 0 for unknown; null if not for walkers."""
    kind = F.coalesce(parking, F.lit("surface"))
    shut = _is(access, *CLOSED) | kind.isin(*GARAGES) | _is(access, "customers")
    estimate = F.when(area != 0, F.greatest(F.lit(1), F.rint(area / _area_per_space(kind, count_of(levels))).cast("int")))
    return F.when(~shut, F.coalesce(count_of(capacity), estimate, F.lit(0)))


def parking_feature(parking, access, capacity, levels, fee_text, charge, area: Column) -> Column:
    """Struct (spaces, est, fee, access, kind, sort_key) of a car park on the map; null if it is not shown."""
    kind = F.coalesce(parking, F.lit("surface"))
    shown = ~_is(access, *CLOSED) & ~kind.isin(*GARAGES)
    folded = F.when(kind.isin(*OWN_PARKING), kind).when(kind.isin(*STREET_PARKING), F.lit("street_side"))
    mapped = count_of(capacity)
    guess = F.when(mapped.isNull() & (area > 0), F.greatest(F.lit(1), F.floor(area / _area_per_space(folded, count_of(levels)) + 0.5).cast("int")))
    spaces = F.coalesce(mapped, guess)
    return F.when(
        shown,
        F.struct(
            spaces.alias("spaces"), F.when(guess.isNotNull(), F.lit(1)).alias("est"), fee(fee_text, charge).alias("fee"),
            F.when(_is(access, "customers"), F.lit("customers")).alias("access"), folded.alias("kind"), F.coalesce(-F.least(spaces, F.lit(100_000)), F.lit(0)).alias("sort_key"),
        ),
    )


def fee(text: Column, charge: Column) -> Column:
    """no, yes, donation, times (some hours), or null; a charge alone says yes."""
    t = F.lower(F.trim(text))
    return (
        F.when(text.isNull(), F.when(charge.isNotNull(), F.lit("yes"))).when(t.isin(*FEE_NO), F.lit("no")).when(t.isin(*FEE_YES), F.lit("yes"))
        .when(t.isin(*FEE_DONATION), F.lit("donation")).when(t.rlike(r"\d\d:\d\d"), F.lit("times"))
    )


def right_of_way(designation: Column) -> Column:
    return lookup(RIGHTS_OF_WAY, designation, "string")


def sac_grade(sac_scale: Column) -> Column:
    return lookup(SAC_GRADE, sac_scale, "int")


def is_private(foot: Column, access: Column) -> Column:
    return ~_is(foot, "yes", "designated", "permissive") & (_is(foot, "no", "private") | _is(access, "no", "private"))


def road_label(ref: Column, name: Column) -> Column:
    """Numbers joined by " / ", a line end, and the name; empty if a road has neither."""
    numbers = F.array_join(F.filter(F.transform(F.split(F.coalesce(ref, F.lit("")), ";"), lambda r: F.trim(r)), lambda r: r != ""), " / ")
    title = F.trim(F.coalesce(name, F.lit("")))
    return F.when((numbers == "") & (title == ""), F.lit("")).otherwise(F.concat(F.translate(numbers, "\n", " "), F.lit("\n"), F.translate(title, "\n", " ")))


def road_kind(highway: Column, junction: Column, route: Column) -> Column:
    """Place of the road's kind in ROAD_KINDS, with a bit for roundabouts; null if it is no road."""
    place = F.array_position(F.array(*map(F.lit, ROAD_KINDS)), F.when(_is(route, "ferry"), F.lit("ferry")).otherwise(highway)) - 1
    return F.when(place >= 0, place.cast("int").bitwiseOR(F.when(_is(junction, "roundabout", "circular"), F.lit(ROUNDABOUT_BIT)).otherwise(F.lit(0))))


def road_word(label: Column, kind: Column) -> Column:
    """Number of a label and kind of a road in one 32-bit word."""
    return label.bitwiseOR(F.shiftleft(kind.cast("int"), 24))


def is_lake(water: Column, waterway: Column, tidal: Column, area_m2: Column) -> Column:
    """Standing water of a hectare or more, by type (no type counts), not a waterway and not tidal."""
    return (water.isNull() | water.isin(*LAKES)) & waterway.isNull() & ~_is(tidal, "yes") & (area_m2 >= 10_000)


def zoom_of_trail(row: Column, highway: Column) -> Column:
    return F.when(row.isNotNull() | highway.isin("track", "bridleway"), F.lit(12)).otherwise(F.lit(13))


def zoom_of_route(network: Column) -> Column:
    return F.when(network.isin("iwn", "nwn"), F.lit(7)).when(network == "rwn", F.lit(9)).otherwise(F.lit(11))


def layer_of(amenity, name, waterway, natural, is_point, highway, designation) -> Column:
    """The one layer that a feature goes to: the first rule that holds takes it from those after."""
    return (
        F.when(_is(amenity, "parking"), F.lit("parking"))
        .when(name.isNotNull() & _is(waterway, "waterfall"), F.lit("waterfall"))
        .when(name.isNotNull() & is_point & _is(natural, "peak", "volcano", "hill"), F.lit("peak"))
        .when(name.isNotNull() & _is(natural, "valley"), F.lit("valley"))
        .when(~is_point & (_is(highway, *FOOT_PATHS, "pedestrian") | (highway.isNotNull() & right_of_way(designation).isNotNull())), F.lit("trail"))
    )
