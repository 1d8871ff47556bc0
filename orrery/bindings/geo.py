"""Geofences (F5, F6), labels (F8, F9), group filter (F10) and the
geospatial operators G1-G11 on deterministic supplier / customer
coordinates."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import geo as GF
from ..functions.common import round_half_up
from ..functions.text import normalize_text, query_variants
from ..operators import geo as G
from ..tables import Tables
from . import standins as S
from .registry import register
from .sqlutil import r2


def _boxes_sql(lat: str, lon: str) -> str:
    return "(" + " OR ".join(f"({lat} BETWEEN {a} AND {b} AND {lon} BETWEEN {c} AND {d})"
                             for _, a, b, c, d in GF.TERRITORY_BOXES) + ")"


@register("f5_geofence", f"""
SELECT c_custkey, COALESCE({_boxes_sql('lat', 'lon')}, FALSE) AS inside,
       NOT COALESCE({_boxes_sql('lat', 'lon')}, FALSE) AS outside,
       CASE """ + " ".join(f"WHEN lat BETWEEN {a} AND {b} AND lon BETWEEN {c} AND {d} THEN '{n}'"
                           for n, a, b, c, d in GF.TERRITORY_BOXES) + f""" END AS zone
FROM ({S.CUSTOMER_GEO_SQL}) g""", ["F5"])
def f5(t: Tables):
    g = S.customer_geo(t)
    inside = GF.in_any_box("lat", "lon")
    return g.select("c_custkey", inside.alias("inside"), (~inside).alias("outside"), GF.box_label("lat", "lon").alias("zone"))


@register("f6_outside_national_box", f"""
SELECT c_custkey, {r2('lat')} AS lat, {r2('lon')} AS lon FROM ({S.CUSTOMER_GEO_SQL}) g
WHERE lat < 26.0 OR lat > 45.0 OR lon < -20.0 OR lon > 6.0 OR lat IS NULL OR lon IS NULL""", ["F6", "Q5"])
def f6(t: Tables):
    g = S.customer_geo(t)
    a, b, c, d = GF.NATIONAL_BOX
    out = g.filter(~F.coalesce(GF.in_box("lat", "lon", a, b, c, d), F.lit(False)))
    return out.select("c_custkey", round_half_up("lat").alias("lat"), round_half_up("lon").alias("lon"))


@register("f8_f9_labels", """
SELECT c_custkey,
  CASE WHEN n_regionkey IN (1, 3) AND c_nationkey % 2 = 0 THEN 'islands_a' WHEN n_regionkey = 2 AND c_nationkey IS NOT NULL THEN 'islands_b'
       ELSE 'mainland' END AS zone,
  CASE WHEN c_acctbal >= 0 THEN 'north' ELSE 'south' END AS hemisphere
FROM customer JOIN nation ON c_nationkey = n_nationkey""", ["F8", "F9", "F11"])
def f8(t: Tables):
    c = t.customer.join(t.nation.select("n_nationkey", "n_regionkey"), F.col("c_nationkey") == F.col("n_nationkey"))
    zone = (F.when(F.col("n_regionkey").isin(1, 3) & (F.col("c_nationkey") % 2 == 0), "islands_a")
            .when((F.col("n_regionkey") == 2) & F.col("c_nationkey").isNotNull(), "islands_b").otherwise("mainland"))
    hemi = F.when(F.col("c_acctbal") >= 0, "north").otherwise("south")
    return c.select("c_custkey", zone.alias("zone"), hemi.alias("hemisphere"))


@register("f10_groups_with_min_rows", """
SELECT l_suppkey, COUNT(*) AS n_lines FROM lineitem GROUP BY l_suppkey HAVING COUNT(*) >= 600""", ["F10"])
def f10(t: Tables):
    from ..operators.aggregates import count_by
    c = count_by(t.lineitem.select("l_suppkey"), "l_suppkey", "n_lines")
    return c.filter(F.col("n_lines") >= 600)


@register("f10_rows_of_large_groups", """
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber FROM lineitem
WHERE l_suppkey IN (SELECT l_suppkey FROM lineitem GROUP BY l_suppkey HAVING COUNT(*) >= 600)""", ["F10", "J5"])
def f10r(t: Tables):
    li = t.lineitem.select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber")
    big = li.groupBy("l_suppkey").count().filter(F.col("count") >= 600).select("l_suppkey")
    return li.join(big, "l_suppkey", "left_semi").select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber")


@register("g1_centroids", f"""
SELECT s_nationkey, {r2('AVG(lat)', 4)} AS lat_centroid, {r2('AVG(lon)', 4)} AS lon_centroid
FROM ({S.SUPPLIER_GEO_SQL}) g GROUP BY s_nationkey""", ["G1"])
def g1(t: Tables):
    return G.centroids(S.supplier_geo(t), ["s_nationkey"], scale=4)


@register("g2_bbox_centroid", f"""
SELECT s_nationkey, {r2('(MAX(lat) + MIN(lat)) / 2', 4)} AS lat_mid, {r2('(MAX(lon) + MIN(lon)) / 2', 4)} AS lon_mid
FROM ({S.SUPPLIER_GEO_SQL}) g GROUP BY s_nationkey""", ["G2"])
def g2(t: Tables):
    b = S.supplier_geo(t).groupBy("s_nationkey").agg(F.max("lat").alias("n"), F.min("lat").alias("s"),
                                                    F.max("lon").alias("e"), F.min("lon").alias("w"))
    la, lo = GF.bbox_centroid("n", "s", "e", "w")
    return b.select("s_nationkey", round_half_up(la, 4).alias("lat_mid"), round_half_up(lo, 4).alias("lon_mid"))


def _hav_sql(la1, lo1, la2, lo2):
    a = (f"POWER(SIN((RADIANS({la2}) - RADIANS({la1})) / 2), 2) + COS(RADIANS({la1})) * COS(RADIANS({la2})) * "
         f"POWER(SIN((RADIANS({lo2}) - RADIANS({lo1})) / 2), 2)")
    return f"(2 * 6371.0 * ATAN2(SQRT({a}), SQRT(1 - ({a}))))"


@register("g3_g5_distance_to_reference", f"""
WITH ref AS (SELECT lat AS rlat, lon AS rlon FROM ({S.SUPPLIER_GEO_SQL}) g WHERE s_suppkey = (SELECT MIN(s_suppkey) FROM supplier)),
d AS (SELECT c_custkey, {_hav_sql('rlat', 'rlon', 'lat', 'lon')} AS dist FROM ({S.CUSTOMER_GEO_SQL}) c, ref)
SELECT c_custkey, {r2('dist')} AS dist_km,
  CASE WHEN dist > 0 AND dist <= 500 THEN 'near' WHEN dist > 500 AND dist <= 1500 THEN 'mid'
       WHEN dist > 1500 AND dist <= 5000 THEN 'far' END AS band
FROM d""", ["G3", "G5", "N11"])
def g3(t: Tables):
    from ..functions.numeric import fixed_bins
    s = S.supplier_geo(t)
    ref = s.join(s.agg(F.min("s_suppkey").alias("s_suppkey")), "s_suppkey").select(
        F.col("lat").alias("ref_lat"), F.col("lon").alias("ref_lon"))
    d = G.distance_to_reference(S.customer_geo(t), ref)
    return d.select("c_custkey", round_half_up("dist_km").alias("dist_km"),
                    fixed_bins("dist_km", [0, 500, 1500, 5000], ["near", "mid", "far"]).alias("band"))


@register("g3_haversine_forms_agree", f"""
SELECT s_suppkey, {r2(_hav_sql('lat', 'lon', '40.4', '-3.7'), 3)} AS d_atan2,
       {r2("2 * 6371.0 * ASIN(SQRT(POWER(SIN((RADIANS(40.4) - RADIANS(lat)) / 2), 2) + COS(RADIANS(lat)) * COS(RADIANS(40.4)) * POWER(SIN((RADIANS(-3.7) - RADIANS(lon)) / 2), 2)))", 3)} AS d_asin
FROM ({S.SUPPLIER_GEO_SQL}) g""", ["G3"])
def g3b(t: Tables):
    s = S.supplier_geo(t)
    return s.select("s_suppkey",
                    round_half_up(GF.haversine_km("lat", "lon", F.lit(40.4), F.lit(-3.7)), 3).alias("d_atan2"),
                    round_half_up(GF.haversine_km("lat", "lon", F.lit(40.4), F.lit(-3.7), form="asin"), 3).alias("d_asin"))


@register("g4_dispersion", f"""
WITH g AS ({S.SUPPLIER_GEO_SQL}),
c AS (SELECT s_nationkey, AVG(lat) AS clat, AVG(lon) AS clon FROM g GROUP BY s_nationkey),
d AS (SELECT g.n_regionkey, g.s_nationkey, {_hav_sql('g.lat', 'g.lon', 'c.clat', 'c.clon')} AS dist
      FROM g JOIN c ON g.s_nationkey = c.s_nationkey),
child AS (SELECT n_regionkey, s_nationkey, AVG(dist) AS m FROM d GROUP BY 1, 2)
SELECT n_regionkey, {r2('AVG(m)')} AS mean_child_dispersion_km, COUNT(*) AS n_children FROM child GROUP BY n_regionkey""",
          ["G4", "G1", "G3"])
def g4(t: Tables):
    return G.dispersion(S.supplier_geo(t), ["n_regionkey", "s_nationkey"], ["n_regionkey"])


@register("g6_most_central_supplier", f"""
WITH g AS ({S.SUPPLIER_GEO_SQL}),
c AS (SELECT s_nationkey, AVG(lat) AS clat, AVG(lon) AS clon FROM g GROUP BY s_nationkey),
d AS (SELECT g.s_nationkey, g.s_suppkey, {_hav_sql('g.lat', 'g.lon', 'c.clat', 'c.clon')} AS dist
      FROM g JOIN c ON g.s_nationkey = c.s_nationkey)
SELECT s_nationkey, arg_min(s_suppkey, (dist, s_suppkey)) AS central_member, {r2('MIN(dist)')} AS central_dist_km
FROM d GROUP BY s_nationkey""", ["G6", "W4"])
def g6(t: Tables):
    m = G.most_central(S.supplier_geo(t), ["s_nationkey"], "s_suppkey")
    return m.select("s_nationkey", "central_member", round_half_up("central_dist_km").alias("central_dist_km"))


@register("g7_location_score", f"""
WITH g AS ({S.SUPPLIER_GEO_SQL}), c AS (SELECT AVG(lat) AS cx, AVG(lon) AS cy FROM g),
d AS (SELECT s_suppkey, SQRT(POWER(lat - cx, 2) + POWER(lon - cy, 2)) AS dd FROM g, c),
m AS (SELECT MIN(dd) AS lo, MAX(dd) AS hi FROM d)
SELECT s_suppkey, {r2('1 - (dd - lo) / NULLIF(hi - lo, 0)', 4)} AS location_score FROM d, m""", ["G7", "W7"])
def g7(t: Tables):
    s = G.location_score(S.supplier_geo(t), "lat", "lon")
    return s.select("s_suppkey", round_half_up("location_score", 4).alias("location_score"))


def _candidates(t: Tables):
    """Geocoder candidates re-aimed on events: entity = user, importance =
    value / 500, type from event_type, rank = minute of the event."""
    e = t.events.select("event_id", "user_id", "event_type", "value", "ts")
    ptype = (F.when(F.col("event_type") == "view", "city").when(F.col("event_type") == "click", "village")
             .otherwise(F.col("event_type")))
    return e.select(F.col("event_id").alias("candidate_id"), F.col("user_id").alias("entity"),
                    (F.col("value") / 500).alias("importance"), ptype.alias("place_type"),
                    F.minute("ts").alias("place_rank"))


_CANDIDATES_SQL = """SELECT event_id AS candidate_id, user_id AS entity, value / 500 AS importance,
  CASE WHEN event_type = 'view' THEN 'city' WHEN event_type = 'click' THEN 'village' ELSE event_type END AS place_type,
  CAST(minute(ts) AS INTEGER) AS place_rank FROM events"""


@register("g8_best_candidate", f"""
SELECT entity, arg_min(candidate_id, (-(COALESCE(importance, 0) + CASE WHEN lower(place_type) IN ('city', 'town', 'village', 'hamlet', 'municipality') THEN 1.0 ELSE 0.0 END), -COALESCE(place_rank, 0), candidate_id)) AS candidate_id
FROM ({_CANDIDATES_SQL}) c GROUP BY entity""", ["G8"])
def g8(t: Tables):
    return G.best_candidate(_candidates(t), "entity").select("entity", "candidate_id")


@register("g9_best_candidate_tiered", f"""
SELECT entity, arg_min(candidate_id, (CASE WHEN place_type = 'city' AND place_rank < 30 THEN 0 WHEN place_type IN ('city', 'village') THEN 1 ELSE 2 END, candidate_id)) AS candidate_id
FROM ({_CANDIDATES_SQL}) c GROUP BY entity""", ["G9"])
def g9(t: Tables):
    c = _candidates(t)
    tiers = [(F.col("place_type") == "city") & (F.col("place_rank") < 30), F.col("place_type").isin("city", "village")]
    return G.best_candidate_tiered(c, "entity", tiers, "candidate_id").select("entity", "candidate_id")


@register("g10_best_by_max", f"""
SELECT entity, arg_max(candidate_id, (importance, -candidate_id)) AS candidate_id FROM ({_CANDIDATES_SQL}) c GROUP BY entity""",
          ["G10"])
def g10(t: Tables):
    return G.best_by_max(_candidates(t), "entity", "importance", "candidate_id").select("entity", "candidate_id")


def _g11_sql() -> str:
    from .text_numbers import _variants_sql
    return f"""
WITH v AS ({_variants_sql('s_name')}),
h AS (SELECT DISTINCT s_name || ', España' AS query, TRUE AS hit FROM supplier WHERE s_acctbal > 0),
b AS (SELECT v.s_suppkey, arg_min(v.query, v.variant_pos) AS query, MIN(v.variant_pos) AS variant_pos, bool_or(h.hit) AS hit
      FROM v JOIN h ON v.query = h.query GROUP BY v.s_suppkey)
SELECT e.s_suppkey, b.query, b.variant_pos, b.hit,
       CASE WHEN b.variant_pos <= 5 THEN 'pass1' WHEN b.variant_pos IS NOT NULL THEN 'pass2' END AS pass
FROM (SELECT DISTINCT s_suppkey FROM v) e LEFT JOIN b ON e.s_suppkey = b.s_suppkey"""


@register("g11_first_variant_with_hit", _g11_sql(), ["G11", "S19"])
def g11(t: Tables):
    """Variants of every supplier's place string (S19) resolved against a
    lookup of known place strings derived from the suppliers: the first
    variant with a hit wins; the pass says whether it came from the first
    five variants."""
    s = (t.supplier.select("s_suppkey", "s_name", "s_nationkey")
         .join(t.nation.select("n_nationkey", "n_name", "n_regionkey"), F.col("s_nationkey") == F.col("n_nationkey"))
         .join(t.region, F.col("n_regionkey") == F.col("r_regionkey")))
    v = s.select("s_suppkey", F.posexplode(query_variants("s_name", "n_name", "r_name")).alias("p", "query"))
    v = v.select("s_suppkey", (F.col("p") + 1).alias("variant_pos"), "query")
    hits = (t.supplier.filter(F.col("s_acctbal") > 0)
            .select(F.concat(F.col("s_name"), F.lit(", España")).alias("query")).distinct()
            .withColumn("hit", F.lit(True)))
    out = G.resolve_first_hit(v, hits, "s_suppkey", "variant_pos", "query", first_pass_max_pos=5)
    return out.select("s_suppkey", "query", "variant_pos", "hit", "pass")


_BOXES_SQL = f"""SELECT s_nationkey AS box_id, MIN(lat) AS lat_min, MAX(lat) - 3 AS lat_max, MIN(lon) + 2 AS lon_min, MAX(lon) AS lon_max
FROM ({S.SUPPLIER_GEO_SQL}) g GROUP BY s_nationkey"""


def _nation_boxes(t: Tables):
    """A box per nation, from the places of its suppliers."""
    return S.supplier_geo(t).groupBy(F.col("s_nationkey").alias("box_id")).agg(
        F.min("lat").alias("lat_min"), (F.max("lat") - 3).alias("lat_max"), (F.min("lon") + 2).alias("lon_min"), F.max("lon").alias("lon_max"))


@register("f5_points_in_box_table", f"""
SELECT c.c_custkey, b.box_id FROM ({S.CUSTOMER_GEO_SQL}) c JOIN ({_BOXES_SQL}) b
ON c.lat BETWEEN b.lat_min AND b.lat_max AND c.lon BETWEEN b.lon_min AND b.lon_max""", ["F5"])
def points_in_box_table(t: Tables):
    return G.match_boxes(S.customer_geo(t).select("c_custkey", "lat", "lon"), _nation_boxes(t)).select("c_custkey", "box_id")


@register("f5_points_in_no_box", f"""
SELECT c.c_custkey FROM ({S.CUSTOMER_GEO_SQL}) c WHERE NOT EXISTS (SELECT 1 FROM ({_BOXES_SQL}) b
WHERE c.lat BETWEEN b.lat_min AND b.lat_max AND c.lon BETWEEN b.lon_min AND b.lon_max)""", ["F5", "F6"])
def points_in_no_box(t: Tables):
    return G.match_boxes(S.customer_geo(t).select("c_custkey", "lat", "lon"), _nation_boxes(t), how="left_anti").select("c_custkey")
