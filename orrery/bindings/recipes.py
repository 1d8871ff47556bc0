"""Recipes M1-M25 bound to the stand-in facts."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.common import round_half_up
from ..plans import recipes as M
from ..tables import Tables
from . import standins as S
from .registry import register
from .sqlutil import r2

M1_SQL = f"""
WITH f AS ({S.LODGING_FACT_SQL}), p AS ({S.PROVINCES_SQL})
SELECT f.country_id, f.province_id, p.province_name, f.category,
       {r2('AVG(f.weekday_price)')} AS avg_weekday,
       {r2('AVG(f.weekend_price)')} AS avg_weekend,
       {r2('AVG((f.weekday_price + f.weekend_price) / 2)')} AS avg_price
FROM f JOIN p ON f.province_id = p.province_id
GROUP BY f.country_id, f.province_id, p.province_name, f.category
"""


def lodging_price_by_province(t: Tables):
    return M.price_by_province(S.lodging_fact(t), S.provinces(t))


register("m1_lodging_price_by_province", M1_SQL, ["M1", "J2", "A9", "A10", "N8"])(lodging_price_by_province)


LF = f"({S.LODGING_FACT_SQL}) f"
AF = f"({S.ACTIVITY_FACT_SQL}) f"


@register("m7_weekend_premium", f"""
SELECT COUNT(*) AS n_pairs, {r2('AVG(CASE WHEN weekend_price > weekday_price THEN 1 ELSE 0 END) * 100')} AS share_higher_pct,
  {r2('AVG(CASE WHEN weekend_price < weekday_price THEN 1 ELSE 0 END) * 100')} AS share_lower_pct,
  {r2('AVG(CASE WHEN weekend_price = weekday_price THEN 1 ELSE 0 END) * 100')} AS share_equal_pct,
  {r2('AVG((weekend_price - weekday_price) / NULLIF(weekday_price, 0) * 100)')} AS mean_premium_pct,
  {r2('median((weekend_price - weekday_price) / NULLIF(weekday_price, 0) * 100)')} AS median_premium_pct
FROM {LF} WHERE weekday_price IS NOT NULL AND weekend_price IS NOT NULL""", ["M7", "N9", "A21", "A16"])
def m7(t: Tables):
    return M.weekend_premium(S.lodging_fact(t))


@register("m8_monthly_seasonality", f"""
WITH m AS (SELECT month, median(weekday_price) AS s FROM {LF} GROUP BY month)
SELECT month, {r2('s')} AS median_value, s = (SELECT MAX(s) FROM m) AS is_peak, s = (SELECT MIN(s) FROM m) AS is_low,
       {r2('(SELECT MAX(s) FROM m) - (SELECT MIN(s) FROM m)')} AS amplitude FROM m""", ["M8", "W5", "A16"])
def m8(t: Tables):
    return M.monthly_seasonality(S.lodging_fact(t), "month", "weekday_price")


@register("m8_monthly_mean", f"""
WITH m AS (SELECT month, {r2('AVG(weekday_price)', 6)} AS s FROM {LF} GROUP BY month)
SELECT month, {r2('s')} AS mean_value, s = (SELECT MAX(s) FROM m) AS is_peak, s = (SELECT MIN(s) FROM m) AS is_low,
       {r2('(SELECT MAX(s) FROM m) - (SELECT MIN(s) FROM m)')} AS amplitude FROM m""", ["M8", "W5", "A1"])
def m8_mean(t: Tables):
    return M.monthly_seasonality(S.lodging_fact(t), "month", "weekday_price", stat="mean")


@register("m8_monthly_median_one_lead_time", f"""
WITH m AS (SELECT month, median(weekday_price) AS s FROM {LF} WHERE month IN (6, 7, 8, 12) GROUP BY month)
SELECT month, {r2('s')} AS median_value, s = (SELECT MAX(s) FROM m) AS is_peak, s = (SELECT MIN(s) FROM m) AS is_low,
       {r2('(SELECT MAX(s) FROM m) - (SELECT MIN(s) FROM m)')} AS amplitude FROM m""", ["M8", "D-6", "A16"])
def m8_lead(t: Tables):
    from ..functions.dates import lead_time_for_month
    f = S.lodging_fact(t).withColumn("lead_time", lead_time_for_month("month"))
    return M.monthly_seasonality(f, "month", "weekday_price", lead_time="lead_time", lead_times=["2-3 meses"])


@register("m9_category_segmentation", f"""
SELECT category, COUNT(*) AS n_rows, {r2('median(weekday_price)')} AS median_weekday, {r2('median(weekend_price)')} AS median_weekend,
  {r2('(median(weekend_price) - median(weekday_price)) / NULLIF(median(weekday_price), 0) * 100')} AS premium_pct
FROM {LF} WHERE CASE WHEN month IN (6, 7, 8, 12) THEN '2-3 meses' ELSE '1 mes' END = '1 mes' GROUP BY category""",
          ["M9", "D-6", "A16"])
def m9(t: Tables):
    from ..functions.dates import lead_time_for_month
    f = S.lodging_fact(t).filter(lead_time_for_month("month") == "1 mes")
    return M.category_segmentation(f, "category")


@register("m10_region_ranking", f"""
WITH g AS (SELECT province_id, COUNT(*) AS n_rows, median(weekday_price) AS med, quantile_cont(weekday_price, 0.25) AS p25,
                  quantile_cont(weekday_price, 0.75) AS p75 FROM {LF} GROUP BY province_id),
n AS (SELECT median(weekday_price) AS nat FROM {LF})
SELECT province_id, n_rows, {r2('med')} AS median, {r2('p25')} AS p25, {r2('p75')} AS p75, {r2('p75 - p25')} AS iqr,
  {r2('med / nat * 100')} AS index_vs_overall, CAST(ROW_NUMBER() OVER (ORDER BY med, province_id) AS INTEGER) AS rank_cheapest
FROM g, n""", ["M10", "A16"])
def m10(t: Tables):
    return M.region_ranking(S.lodging_fact(t), "province_id", "weekday_price")


@register("m11_price_quality_quartiles", f"""
WITH b AS (SELECT * FROM {LF} WHERE weekday_price IS NOT NULL),
q AS (SELECT quantile_cont(weekday_price, [0.0, 0.25, 0.5, 0.75, 1.0]) AS e FROM b),
x AS (SELECT b.*, CASE WHEN weekday_price >= e[1] AND weekday_price <= e[2] THEN 'Q1' WHEN weekday_price > e[2] AND weekday_price <= e[3] THEN 'Q2'
                       WHEN weekday_price > e[3] AND weekday_price <= e[4] THEN 'Q3' WHEN weekday_price > e[4] AND weekday_price <= e[5] THEN 'Q4' END AS price_quartile
      FROM b, q)
SELECT price_quartile, COUNT(*) AS n_rows, {r2('median(weekday_price)')} AS median_price, {r2('median(rating)')} AS median_rating
FROM x GROUP BY price_quartile""", ["M11", "N12", "A16"])
def m11(t: Tables):
    return M.price_quality_quartiles(S.lodging_fact(t), "weekday_price", "rating")


@register("m12_overpriced_top10", f"""
WITH b AS (SELECT quantile_cont(weekday_price, 0.75) AS p75, quantile_cont(rating, 0.25) AS r25 FROM {LF})
SELECT supplier_id, month, category, {r2('weekday_price')} AS price, {r2('rating')} AS rating
FROM {LF}, b WHERE weekday_price >= p75 AND rating <= r25
ORDER BY weekday_price DESC, supplier_id, month, category LIMIT 10""", ["M12", "A17", "T2"])
def m12(t: Tables):
    from ..functions.common import round_half_up
    o = M.overpriced(S.lodging_fact(t), "weekday_price", "rating", 10, ["supplier_id", "month", "category"])
    return o.select("supplier_id", "month", "category", round_half_up("weekday_price").alias("price"),
                    round_half_up("rating").alias("rating"))


@register("m13_quality_price_score", f"""
WITH b AS (SELECT MIN(rating) AS rlo, MAX(rating) AS rhi, quantile_cont(weekday_price, 0.05) AS plo,
                  quantile_cont(weekday_price, 0.95) AS phi FROM {LF})
SELECT supplier_id, month, category,
  {r2('0.6 * ((rating - rlo) / NULLIF(rhi - rlo, 0)) + 0.4 * (1 - (LEAST(GREATEST(weekday_price, plo), phi) - plo) / NULLIF(phi - plo, 0))', 4)} AS qp_score
FROM {LF}, b""", ["M13", "W8", "W7", "N13"])
def m13(t: Tables):
    from ..functions.common import round_half_up
    s = M.quality_price_score(S.lodging_fact(t), "weekday_price", "rating")
    return s.select("supplier_id", "month", "category", round_half_up("qp_score", 4).alias("qp_score"))


@register("m14_price_value_score", f"""
WITH g AS (SELECT province_id, COUNT(*) AS n_rows, median(weekday_price) AS mp, AVG(rating) AS mr FROM {LF}
           GROUP BY province_id HAVING COUNT(*) >= 100),
m AS (SELECT MIN(mp) AS plo, MAX(mp) AS phi, MIN(mr) AS rlo, MAX(mr) AS rhi FROM g)
SELECT province_id, n_rows, {r2('mp')} AS median_price, {r2('mr')} AS mean_rating,
  {r2('0.5 * (1 - (mp - plo) / NULLIF(phi - plo, 0)) + 0.5 * ((mr - rlo) / NULLIF(rhi - rlo, 0))', 4)} AS value_score
FROM g, m""", ["M14", "F10", "W7", "N13"])
def m14(t: Tables):
    from ..functions.common import round_half_up
    s = M.price_value_score(S.lodging_fact(t), "province_id", "weekday_price", "rating", 100)
    return s.select("province_id", "n_rows", round_half_up("median_price").alias("median_price"),
                    round_half_up("mean_rating").alias("mean_rating"), round_half_up("value_score", 4).alias("value_score"))


@register("m15_strategic_score_top10", f"""
WITH s AS (SELECT supplier_id, AVG((COALESCE(weekday_price, 0) + COALESCE(weekend_price, 0)) /
                   NULLIF((weekday_price IS NOT NULL)::INT + (weekend_price IS NOT NULL)::INT, 0)) AS price, AVG(rating) AS rating
           FROM {LF} GROUP BY supplier_id),
g AS ({S.SUPPLIER_GEO_SQL}), c AS (SELECT AVG(lat) AS cx, AVG(lon) AS cy FROM g),
d AS (SELECT s_suppkey, SQRT(POWER(lat - cx, 2) + POWER(lon - cy, 2)) AS dd FROM g, c),
dm AS (SELECT MIN(dd) AS lo, MAX(dd) AS hi FROM d),
loc AS (SELECT s_suppkey, 1 - (dd - lo) / NULLIF(hi - lo, 0) AS location_score FROM d, dm),
j AS (SELECT s.*, loc.location_score FROM s JOIN loc ON s.supplier_id = loc.s_suppkey),
m AS (SELECT MIN(price) AS plo, MAX(price) AS phi, MIN(rating) AS rlo, MAX(rating) AS rhi FROM j),
sc AS (SELECT supplier_id, 0.4 * (1 - (price - plo) / NULLIF(phi - plo, 0)) + 0.4 * ((rating - rlo) / NULLIF(rhi - rlo, 0))
                      + 0.2 * location_score AS score FROM j, m)
SELECT supplier_id, {r2('score', 4)} AS strategic_score FROM sc ORDER BY score DESC, supplier_id LIMIT 10""",
          ["M15", "G7", "W7", "N10", "N13", "T2"])
def m15(t: Tables):
    from ..functions.common import round_half_up
    from ..functions.numeric import row_mean
    from ..operators.geo import location_score
    f = S.lodging_fact(t).withColumn("__m", row_mean("weekday_price", "weekend_price"))
    s = f.groupBy("supplier_id").agg(F.avg("__m").alias("price"), F.avg("rating").alias("rating"))
    loc = location_score(S.supplier_geo(t), "lat", "lon").select(F.col("s_suppkey").alias("supplier_id"), "location_score")
    sc = M.strategic_score(s.join(loc, "supplier_id"), "price", "rating", "location_score")
    top = sc.orderBy(F.col("strategic_score").desc(), "supplier_id").limit(10)
    return top.select("supplier_id", round_half_up("strategic_score", 4).alias("strategic_score"))


@register("m16_saving_by_month", f"""
SELECT month, {r2('quantile_cont(entry_price, 0.25)')} AS p25, {r2('quantile_cont(entry_price, 0.75)')} AS p75,
  {r2('(quantile_cont(entry_price, 0.75) - quantile_cont(entry_price, 0.25)) / NULLIF(quantile_cont(entry_price, 0.75), 0) * 100')} AS saving_pct
FROM {AF} GROUP BY month""", ["M16", "A16"])
def m16(t: Tables):
    return M.potential_saving(S.activity_fact(t), ["month"], "entry_price")


@register("m16_saving_by_province", f"""
SELECT province_id, {r2('quantile_cont(total_spend, 0.25)')} AS p25, {r2('quantile_cont(total_spend, 0.75)')} AS p75,
  {r2('(quantile_cont(total_spend, 0.75) - quantile_cont(total_spend, 0.25)) / NULLIF(quantile_cont(total_spend, 0.75), 0) * 100')} AS saving_pct
FROM {AF} GROUP BY province_id""", ["M16"])
def m16p(t: Tables):
    return M.potential_saving(S.activity_fact(t), ["province_id"], "total_spend")


@register("m17_rating_confidence", f"""
SELECT CASE WHEN opinions > 0 AND opinions <= 10 THEN '1-10' WHEN opinions > 10 AND opinions <= 25 THEN '11-25'
            WHEN opinions > 25 AND opinions <= 50 THEN '26-50' END AS opinion_bin,
       COUNT(*) AS n_rows, {r2('AVG(rating)')} AS mean_rating
FROM {AF} GROUP BY 1""", ["M17", "N11", "A1"])
def m17(t: Tables):
    return M.rating_confidence(S.activity_fact(t), "opinions", "rating", [0, 10, 25, 50], ["1-10", "11-25", "26-50"])


@register("m18_rating_coverage", f"""
WITH g AS (SELECT rating IS NOT NULL AS has_rating, COUNT(*) AS n_rows, {r2('AVG(total_spend)')} AS avg_total_spend,
                  {r2('AVG(entry_price)')} AS avg_entry_price FROM {AF} GROUP BY 1)
SELECT *, {r2('n_rows * 100.0 / SUM(n_rows) OVER ()')} AS share_pct FROM g""", ["M18", "A2", "F12"])
def m18(t: Tables):
    return M.rating_coverage(S.activity_fact(t), "rating", ["total_spend", "entry_price"])


@register("m19_category_summary", f"""
SELECT category, COUNT(*) AS n_rows, {r2('AVG(total_spend)')} AS avg_total_spend, {r2('AVG(entry_price)')} AS avg_entry_price,
       {r2('SUM(total_spend)')} AS sum_total_spend
FROM {AF} GROUP BY category""", ["M19", "A1", "T1"])
def m19(t: Tables):
    return M.group_summary(S.activity_fact(t), ["category"], ["total_spend", "entry_price"], "total_spend").orderBy(
        F.col("sum_total_spend").desc())


def _group_sql(key: str) -> str:
    return f"""SELECT {key}, COUNT(*) AS n_rows, {r2('AVG(total_spend)')} AS avg_total_spend, {r2('AVG(entry_price)')} AS avg_entry_price,
       {r2('SUM(total_spend)')} AS sum_total_spend FROM {AF} GROUP BY {key}"""


for _key, _name in (("product", "product"), ("country_id", "region"), ("province_id", "province")):
    register(f"m19_{_name}_summary", _group_sql(_key), ["M19", "A1"])(
        lambda t, k=_key: M.group_summary(S.activity_fact(t), [k], ["total_spend", "entry_price"], "total_spend"))


@register("m20_extremes", f"""
WITH q AS (SELECT quantile_cont(total_spend, 0.95) AS p95, quantile_cont(total_spend, 0.99) AS p99 FROM {AF})
SELECT {r2('ANY_VALUE(p95)')} AS p95, {r2('ANY_VALUE(p99)')} AS p99, COUNT(*) FILTER (WHERE total_spend > p95) AS n_above_p95,
       COUNT(*) FILTER (WHERE total_spend > p99) AS n_above_p99 FROM {AF}, q""", ["M20", "A17"])
def m20(t: Tables):
    return M.extremes_report(S.activity_fact(t), "total_spend")


@register("m20_dearest_rows", f"""
SELECT l_orderkey, l_linenumber, {r2('l_extendedprice')} AS total_spend FROM lineitem
ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber LIMIT 10""", ["M20", "T2"])
def m20_top(t: Tables):
    from ..operators.topk import top_n
    li = t.lineitem.select("l_orderkey", "l_linenumber", "l_extendedprice")
    return top_n(li, [F.col("l_extendedprice").desc()], 10, ["l_orderkey", "l_linenumber"]).select(
        "l_orderkey", "l_linenumber", round_half_up("l_extendedprice").alias("total_spend"))


@register("m21_mode_share_and_trend", f"""
WITH c AS (SELECT o_orderpriority, CAST(year(o_orderdate) AS INTEGER) AS yr, COUNT(*) AS n FROM orders GROUP BY 1, 2)
SELECT o_orderpriority, yr, n, {r2('n * 100.0 / SUM(n) OVER (PARTITION BY yr)')} AS share_pct,
  {r2('(n - LAG(n) OVER (PARTITION BY o_orderpriority ORDER BY yr)) * 100.0 / NULLIF(LAG(n) OVER (PARTITION BY o_orderpriority ORDER BY yr), 0)')} AS pct_change
FROM c""", ["M21", "W2", "W6"])
def m21(t: Tables):
    from ..operators.windows import period_change, share_within
    c = t.orders.groupBy("o_orderpriority", F.year("o_orderdate").alias("yr")).agg(F.count(F.lit(1)).alias("n"))
    return period_change(share_within(c, ["yr"], "n"), ["o_orderpriority"], "yr", "n")


_ROUTES_SQL = """SELECT cn.n_name || ' - ' || sn.n_name AS route, l.l_suppkey AS operator, l.l_extendedprice AS price,
  CAST(month(l.l_shipdate) AS INTEGER) AS month
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey JOIN customer c ON o.o_custkey = c.c_custkey
JOIN nation cn ON c.c_nationkey = cn.n_nationkey JOIN supplier s ON l.l_suppkey = s.s_suppkey
JOIN nation sn ON s.s_nationkey = sn.n_nationkey"""


def _routes(t: Tables):
    from ..functions.text import join_id
    li = t.lineitem.select("l_orderkey", "l_suppkey", "l_extendedprice", "l_shipdate")
    o = t.orders.select("o_orderkey", "o_custkey")
    c = t.customer.select("c_custkey", "c_nationkey")
    s = t.supplier.select("s_suppkey", "s_nationkey")
    cn = t.nation.select(F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("cn"))
    sn = t.nation.select(F.col("n_nationkey").alias("s_nationkey"), F.col("n_name").alias("sn"))
    j = (li.join(o, li.l_orderkey == o.o_orderkey).join(c, F.col("o_custkey") == F.col("c_custkey"))
         .join(cn, "c_nationkey").join(s, F.col("l_suppkey") == F.col("s_suppkey")).join(sn, "s_nationkey"))
    return j.select(join_id("cn", "sn", sep=" - ").alias("route"), F.col("l_suppkey").alias("operator"),
                    F.col("l_extendedprice").alias("price"), F.month("l_shipdate").alias("month"))


@register("m22_route_summary", f"""
SELECT route, COUNT(*) AS n_trips, COUNT(DISTINCT operator) AS n_operators, {r2('AVG(price)')} AS avg_price,
       {r2('median(price)')} AS median_price, {r2('MIN(price)')} AS min_price, {r2('MAX(price)')} AS max_price
FROM ({_ROUTES_SQL}) r GROUP BY route""", ["M22", "S12", "S14", "A19"])
def m22(t: Tables):
    from ..functions.common import round_half_up
    from ..operators.quantiles import with_quantiles
    r = _routes(t)
    g = r.groupBy("route").agg(F.count(F.lit(1)).alias("n_trips"), F.countDistinct("operator").alias("n_operators"),
                               round_half_up(F.avg("price")).alias("avg_price"),
                               round_half_up(F.min("price")).alias("min_price"),
                               round_half_up(F.max("price")).alias("max_price"))
    return with_quantiles(g, r, "price", {"median_price": 0.5}, ["route"], 2)


@register("m22_operator_share_by_route", f"""
WITH c AS (SELECT route, operator, COUNT(*) AS n FROM ({_ROUTES_SQL}) r GROUP BY 1, 2)
SELECT route, operator, n, {r2('n * 100.0 / SUM(n) OVER (PARTITION BY route)')} AS share_pct FROM c""", ["M22", "W2"])
def m22b(t: Tables):
    from ..operators.windows import share_within
    c = _routes(t).groupBy("route", "operator").agg(F.count(F.lit(1)).alias("n"))
    return share_within(c, ["route"], "n")


def _stats_sql(keys: str) -> str:
    return f"""SELECT {keys}, COUNT(price) AS n_trips, {r2('AVG(price)')} AS avg_price, {r2('MIN(price)')} AS min_price,
       {r2('MAX(price)')} AS max_price, {r2('median(price)')} AS median_price FROM ({_ROUTES_SQL}) r GROUP BY {keys}"""


@register("m22_route_operator_prices", _stats_sql("route, operator"), ["M22", "A19"])
def m22_operator(t: Tables):
    return M.price_stats(_routes(t), ["route", "operator"], "price")


@register("m22_monthly_route_operator_price", f"""
SELECT route, operator, month, {r2('AVG(price)')} AS avg_price FROM ({_ROUTES_SQL}) r GROUP BY 1, 2, 3""", ["M22", "A1"])
def m22_monthly(t: Tables):
    return _routes(t).groupBy("route", "operator", "month").agg(round_half_up(F.avg("price")).alias("avg_price"))


@register("m22_month_extremes", f"""
WITH m AS (SELECT month, {r2('AVG(price)', 6)} AS p FROM ({_ROUTES_SQL}) r GROUP BY 1)
SELECT month, {r2('p')} AS avg_price, ROW_NUMBER() OVER (ORDER BY p, month) <= 3 AS is_cheapest,
       ROW_NUMBER() OVER (ORDER BY p DESC, month) <= 3 AS is_dearest FROM m""", ["M22", "T3", "W5"])
def m22_months(t: Tables):
    return M.month_extremes(_routes(t), "month", "price")


@register("m22_operator_ranking", f"""
WITH g AS (SELECT operator, COUNT(*) AS n_trips, {r2('AVG(price)')} AS avg_price, COUNT(DISTINCT route) AS n_routes FROM ({_ROUTES_SQL}) r GROUP BY 1)
SELECT *, CAST(RANK() OVER (ORDER BY avg_price) AS INTEGER) AS price_rank FROM g""", ["M22", "W10"])
def m22_ranking(t: Tables):
    """Operators are as many as suppliers: the rank is taken over one row each."""
    from pyspark.sql import Window
    g = _routes(t).groupBy("operator").agg(F.count(F.lit(1)).alias("n_trips"), round_half_up(F.avg("price")).alias("avg_price"),
                                           F.countDistinct("route").alias("n_routes"))
    return g.withColumn("price_rank", F.rank().over(Window.orderBy("avg_price")))


_DOW = list(range(1, 8))


@register("m23_heat_table", "SELECT event_type, " + ", ".join(
    f"{r2(f'AVG(CASE WHEN dayofweek(ts) + 1 = {d} THEN value END)')} AS d{d}" for d in _DOW) +
    " FROM events GROUP BY event_type", ["M23", "R2"])
def m23(t: Tables):
    from ..operators.reshape import pivot_mean
    e = t.events.select("event_type", "value", F.dayofweek("ts").alias("dow"))
    return pivot_mean(e, ["event_type"], "dow", _DOW, "value", names=[f"d{d}" for d in _DOW])


@register("m23_distribution_and_correlation", f"""
SELECT event_type, COUNT(value) AS count, {r2('AVG(value)')} AS mean, {r2('STDDEV_SAMP(value)')} AS std,
       {r2('MIN(value)')} AS min, {r2('quantile_cont(value, 0.25)')} AS p25, {r2('quantile_cont(value, 0.5)')} AS p50,
       {r2('quantile_cont(value, 0.75)')} AS p75, {r2('MAX(value)')} AS max,
       {r2('CORR(value, CAST(hour(ts) AS DOUBLE))', 4)} AS corr_value_hour
FROM events GROUP BY event_type""", ["M23", "A19", "A20"])
def m23b(t: Tables):
    from ..functions.common import round_half_up
    from ..operators.aggregates import numeric_profile
    e = t.events.select("event_type", "value", F.hour("ts").cast("double").alias("hr"))
    p = numeric_profile(e, "value", ["event_type"])
    c = e.groupBy("event_type").agg(round_half_up(F.corr("value", "hr"), 4).alias("corr_value_hour"))
    return p.join(c, "event_type")


@register("m23_distribution_by_month", f"""
SELECT CAST(month(ts) AS INTEGER) AS month, COUNT(value) AS count, {r2('AVG(value)')} AS mean, {r2('STDDEV_SAMP(value)')} AS std,
       {r2('MIN(value)')} AS min, {r2('quantile_cont(value, 0.25)')} AS p25, {r2('quantile_cont(value, 0.5)')} AS p50,
       {r2('quantile_cont(value, 0.75)')} AS p75, {r2('MAX(value)')} AS max FROM events GROUP BY 1""", ["M23", "A19"])
def m23_month(t: Tables):
    from ..operators.aggregates import numeric_profile
    return numeric_profile(t.events.select(F.month("ts").alias("month"), "value"), "value", ["month"])


@register("m24_lead_time_mix", f"""
WITH g AS (SELECT month, CASE WHEN month IN (6, 7, 8, 12) THEN '2-3 meses' ELSE '1 mes' END AS lead_time, COUNT(*) AS n_rows,
                  {r2('median(weekday_price)')} AS median_value FROM {LF} GROUP BY 1, 2)
SELECT *, {r2('n_rows * 100.0 / SUM(n_rows) OVER (PARTITION BY month)')} AS share_pct FROM g""", ["M24", "W12", "D-6"])
def m24(t: Tables):
    from ..functions.dates import lead_time_for_month
    f = S.lodging_fact(t).withColumn("lead_time", lead_time_for_month("month"))
    return M.lead_time_mix(f, "month", "lead_time", "weekday_price")


# ------------------------------------------------------------ fact builders
from .sqlutil import normalize as _norm_sql  # noqa: E402
from .sqlutil import parse_spanish as _parse_sql  # noqa: E402
from .sqlutil import spanish_text as _es_sql  # noqa: E402


def _lodging_raw(t: Tables):
    from ..functions.dates import is_weekend_night
    from ..functions.text import format_money
    li = t.lineitem.select("l_orderkey", "l_linenumber", "l_suppkey", "l_shipdate", "l_returnflag", "l_extendedprice")
    s = t.supplier.select("s_suppkey", "s_nationkey")
    n = t.nation.select("n_nationkey", "n_name")
    j = li.join(s, F.col("l_suppkey") == F.col("s_suppkey")).join(n, F.col("s_nationkey") == F.col("n_nationkey"))
    we = is_weekend_night("l_shipdate")
    txt = F.when(F.col("l_orderkey") % 7 == 0, F.lit("-")).otherwise(format_money("l_extendedprice", symbol=""))
    prov = F.when(F.col("s_suppkey") % 11 == 0, F.lit("Unknown Place")).otherwise(
        F.concat(F.lit("  "), F.lower("n_name"), F.lit(" ")))
    return j.select(prov.alias("province_text"), F.month("l_shipdate").alias("month"),
                    F.col("l_returnflag").alias("category"),
                    F.when(F.col("l_linenumber") % 2 == 0, " 1 Mes").when(F.col("l_linenumber") < 7, "2-3 MESES ").alias("lead_text"),
                    F.when(~we, txt).alias("weekday_text"), F.when(we, txt).alias("weekend_text"))


def _lodging_ratings(t: Tables):
    li = t.lineitem.filter(F.col("l_returnflag") != "N").select("l_suppkey", "l_shipdate", "l_returnflag", "l_discount")
    s = t.supplier.select("s_suppkey", "s_nationkey")
    n = t.nation.select("n_nationkey", "n_regionkey")
    return (li.join(s, F.col("l_suppkey") == F.col("s_suppkey")).join(n, F.col("s_nationkey") == F.col("n_nationkey"))
            .select(F.col("n_regionkey").alias("country_id"), F.col("s_nationkey").alias("province_id"),
                    F.month("l_shipdate").alias("month"), F.col("l_returnflag").alias("category"),
                    (F.col("l_discount") * 1000).alias("rating_0_100")))


def _rentals(t: Tables):
    """Region-grain rows: type = the order's priority; the last type has no rating."""
    o = t.orders.select("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate", "o_orderpriority")
    c = t.customer.select("c_custkey", "c_nationkey", "c_acctbal")
    n = t.nation.select("n_nationkey", "n_regionkey")
    low = F.col("o_orderpriority").startswith("5")
    return (o.join(c, F.col("o_custkey") == F.col("c_custkey")).join(n, F.col("c_nationkey") == F.col("n_nationkey"))
            .groupBy(F.col("n_regionkey").alias("country_id"), F.month("o_orderdate").alias("month"),
                     F.col("o_orderpriority").alias("category"),
                     F.when(F.col("o_orderkey") % 2 == 0, "1 mes").otherwise("2-3 meses").alias("lead_time"))
            .agg(round_half_up(F.avg(F.col("o_totalprice") / 100)).alias("weekday_price"),
                 round_half_up(F.avg(F.col("o_totalprice") / 80)).alias("weekend_price"),
                 round_half_up(F.avg(F.when(~low, F.col("c_acctbal") / 2000))).alias("rating")))


def lodging_fact_build(t: Tables):
    bridge = t.nation.select(F.col("n_regionkey").alias("country_id"), F.col("n_nationkey").alias("province_id"))
    return M.build_lodging_fact(_lodging_raw(t), S.provinces(t), _lodging_ratings(t), _rentals(t), bridge)


def _impute_sql(src: str, col: str, out: str) -> str:
    lv = [["country_id", "province_id", "month", "category", "lead_time"], ["country_id", "province_id", "month", "category"],
          ["country_id", "month", "category"]]
    steps, prev = [], col
    for i, keys in enumerate(lv):
        ok = " AND ".join(f"{k} IS NOT NULL" for k in keys)
        steps.append((f"{out}{i}", f"COALESCE({prev}, CASE WHEN {ok} THEN AVG({prev}) OVER (PARTITION BY {', '.join(keys)}) END)"))
        prev = f"{out}{i}"
    sql = src
    for name, expr in steps:
        sql = f"SELECT *, {expr} AS {name} FROM ({sql}) z"
    return f"SELECT *, COALESCE({prev}, AVG({prev}) OVER ()) AS {out} FROM ({sql}) z"


def _m4_sql() -> str:
    txt = f"CASE WHEN l_orderkey % 7 = 0 THEN '-' ELSE {_es_sql('l_extendedprice')} END"
    prov = "CASE WHEN s_suppkey % 11 = 0 THEN 'Unknown Place' ELSE '  ' || lower(n_name) || ' ' END"
    raw = f"""SELECT {_norm_sql(prov)} AS province_key, CAST(month(l_shipdate) AS INTEGER) AS month, l_returnflag AS category,
      CASE WHEN l_linenumber % 2 = 0 THEN '1 mes' WHEN l_linenumber < 7 THEN '2-3 meses' END AS lead_time,
      {_parse_sql(f"CASE WHEN dayofweek(l_shipdate) NOT IN (5, 6) THEN {txt} END")} AS weekday_price,
      {_parse_sql(f"CASE WHEN dayofweek(l_shipdate) IN (5, 6) THEN {txt} END")} AS weekend_price
      FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey"""
    dim = f"SELECT {_norm_sql('n_name')} AS province_key, n_nationkey AS province_id, n_regionkey AS country_id FROM nation"
    r = f"SELECT raw.*, dim.province_id, dim.country_id FROM ({raw}) raw LEFT JOIN ({dim}) dim ON raw.province_key = dim.province_key"
    imp = _impute_sql(_impute_sql(r, "weekday_price", "wd"), "weekend_price", "we")
    return f"""
WITH imp AS ({imp}),
g AS (SELECT country_id, province_id, month, category, lead_time, {r2('AVG(wd)')} AS weekday_price, {r2('AVG(we)')} AS weekend_price
      FROM imp WHERE country_id IS NOT NULL AND province_id IS NOT NULL AND month IS NOT NULL AND category IS NOT NULL
        AND lead_time IS NOT NULL GROUP BY 1, 2, 3, 4, 5),
rt AS (SELECT n_regionkey AS country_id, s_nationkey AS province_id, CAST(month(l_shipdate) AS INTEGER) AS month,
              l_returnflag AS category, {r2('AVG(l_discount * 1000) / 20.0')} AS rating
       FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey
       WHERE l_returnflag <> 'N' GROUP BY 1, 2, 3, 4),
hotels AS (SELECT g.*, rt.rating, 'hotel' AS source, 'province' AS origin_grain, FALSE AS is_replicated
           FROM g LEFT JOIN rt USING (country_id, province_id, month, category)),
reg AS (SELECT n_regionkey AS country_id, CAST(month(o_orderdate) AS INTEGER) AS month, o_orderpriority AS category,
               CASE WHEN o_orderkey % 2 = 0 THEN '1 mes' ELSE '2-3 meses' END AS lead_time,
               {r2('AVG(o_totalprice / 100)')} AS weekday_price, {r2('AVG(o_totalprice / 80)')} AS weekend_price,
               {r2("AVG(CASE WHEN o_orderpriority NOT LIKE '5%' THEN c_acctbal / 2000 END)")} AS rating
        FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY 1, 2, 3, 4),
rentals AS (SELECT reg.country_id, n_nationkey AS province_id, month, category, lead_time, weekday_price, weekend_price, rating,
                   'rentals' AS source, 'region' AS origin_grain, TRUE AS is_replicated
            FROM reg LEFT JOIN nation ON country_id = n_regionkey),
u AS (SELECT country_id, province_id, month, category, lead_time, weekday_price, weekend_price, rating, source, origin_grain,
             is_replicated FROM hotels UNION ALL SELECT * FROM rentals)
SELECT *, rating IS NOT NULL AS has_rating, 'province' AS geo_level,
       ROW_NUMBER() OVER (ORDER BY country_id, province_id, month, category, lead_time, source) AS lodging_id FROM u"""


M4_SQL = _m4_sql()
register("m4_lodging_fact_build", M4_SQL, ["M4", "N1", "S1", "J1", "W1", "A1", "N6", "F12", "J8", "U1", "F11", "W10"])(
    lodging_fact_build)


@register("m25_source_comparison", f"""
SELECT source, is_replicated, COUNT(*) AS n_rows, {r2('AVG(weekday_price)')} AS avg_weekday_price,
       {r2('AVG(weekend_price)')} AS avg_weekend_price FROM ({M4_SQL}) m GROUP BY 1, 2""", ["M25"])
def m25(t: Tables):
    return M.source_comparison(lodging_fact_build(t), "source", "is_replicated", ["weekday_price", "weekend_price"])


@register("m7_weekend_premium_excluding_copies", f"""
SELECT COUNT(*) AS n_pairs, {r2('AVG(CASE WHEN weekend_price > weekday_price THEN 1 ELSE 0 END) * 100')} AS share_higher_pct,
  {r2('AVG(CASE WHEN weekend_price < weekday_price THEN 1 ELSE 0 END) * 100')} AS share_lower_pct,
  {r2('AVG(CASE WHEN weekend_price = weekday_price THEN 1 ELSE 0 END) * 100')} AS share_equal_pct,
  {r2('AVG((weekend_price - weekday_price) / NULLIF(weekday_price, 0) * 100)')} AS mean_premium_pct,
  {r2('median((weekend_price - weekday_price) / NULLIF(weekday_price, 0) * 100)')} AS median_premium_pct
FROM ({M4_SQL}) m WHERE weekday_price IS NOT NULL AND weekend_price IS NOT NULL AND NOT is_replicated""", ["M7", "X14"])
def m7x(t: Tables):
    return M.weekend_premium(lodging_fact_build(t), exclude_flag="is_replicated")


ACTIVITY_CATEGORY_MAP = {"PROMO": "comida y bebida", "STANDARD": "servicios", "LARGE": "otros"}
_CAT_SQL = ("CASE p_type WHEN 'PROMO' THEN 'comida y bebida' WHEN 'STANDARD' THEN 'servicios' "
            "WHEN 'LARGE' THEN 'otros' ELSE p_type END")


def activity_fact_build(t: Tables):
    from ..functions.text import format_money
    li = t.lineitem.select("l_orderkey", "l_partkey", "l_suppkey", "l_shipdate", "l_extendedprice", "l_discount",
                           "l_quantity", "l_returnflag")
    p = t.part.select("p_partkey", "p_type", "p_brand", "p_retailprice")
    s = t.supplier.select("s_suppkey", "s_nationkey")
    n = t.nation.select("n_nationkey", "n_regionkey")
    j = (li.join(p, F.col("l_partkey") == F.col("p_partkey")).join(s, F.col("l_suppkey") == F.col("s_suppkey"))
         .join(n, F.col("s_nationkey") == F.col("n_nationkey")))
    raw = j.select(F.col("n_regionkey").alias("country_id"), F.col("s_nationkey").alias("province_id"),
                   F.month("l_shipdate").alias("month"), F.col("p_type").alias("category"),
                   F.col("p_brand").alias("product"), format_money("p_retailprice", symbol="").alias("price_text"),
                   F.when(F.col("l_orderkey") % 13 == 0, F.lit("n/d"))
                   .otherwise(format_money("l_extendedprice", symbol="")).alias("spend_text"))
    from ..operators.joins import map_values
    rated = map_values(j.filter(F.col("l_returnflag") == "R"), "p_type", ACTIVITY_CATEGORY_MAP, mode="replace",
                       output="category")
    ratings = rated.groupBy(F.col("n_regionkey").alias("country_id"), F.col("s_nationkey").alias("province_id"), "category").agg(
        round_half_up(F.avg("l_discount") * 50).alias("category_rating"),
        round_half_up(F.avg(F.when(F.col("l_quantity") > 10, F.col("l_discount"))) * 50).alias("general_rating"),
        round_half_up(F.avg("l_quantity")).alias("opinions"))
    return M.build_activity_fact(raw, ACTIVITY_CATEGORY_MAP, ratings)


@register("m5_activity_fact_build", f"""
WITH j AS (SELECT * FROM lineitem JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey
           JOIN nation ON s_nationkey = n_nationkey),
raw AS (SELECT n_regionkey AS country_id, s_nationkey AS province_id, CAST(month(l_shipdate) AS INTEGER) AS month,
               p_type AS category, p_brand AS product, {_parse_sql(_es_sql('p_retailprice'))} AS entry_price,
               {_parse_sql(f"CASE WHEN l_orderkey % 13 = 0 THEN 'n/d' ELSE {_es_sql('l_extendedprice')} END")} AS total_spend FROM j),
g AS (SELECT country_id, province_id, month, category, product, {r2('AVG(total_spend)')} AS total_spend,
             {r2('AVG(entry_price)')} AS entry_price FROM raw GROUP BY 1, 2, 3, 4, 5),
gm AS (SELECT country_id, province_id, month, CASE category WHEN 'PROMO' THEN 'comida y bebida' WHEN 'STANDARD' THEN 'servicios'
              WHEN 'LARGE' THEN 'otros' ELSE category END AS category, product, total_spend, entry_price FROM g),
rt AS (SELECT n_regionkey AS country_id, s_nationkey AS province_id, {_CAT_SQL} AS category,
              {r2('AVG(l_discount) * 50')} AS category_rating,
              {r2('AVG(CASE WHEN l_quantity > 10 THEN l_discount END) * 50')} AS general_rating, {r2('AVG(l_quantity)')} AS opinions
       FROM j WHERE l_returnflag = 'R' GROUP BY 1, 2, 3)
SELECT gm.*, category_rating, general_rating, opinions, general_rating IS NOT NULL AS has_rating
FROM gm LEFT JOIN rt USING (country_id, province_id, category)""",
          ["M5", "N1", "A1", "J10", "J1", "F12"])
def m5(t: Tables):
    return activity_fact_build(t)


@register("m6_geo_dimension_build", f"""
SELECT DISTINCT s.s_suppkey AS member_id, {_norm_sql('s.s_name')} AS member_name, code AS member_code,
       substring(code, 3, 6) AS partial_code, lpad(CAST(s.s_nationkey AS VARCHAR), 2, '0') AS parent_code,
       lpad(CAST(n.n_regionkey AS VARCHAR), 2, '0') AS grandparent_code, n.n_name AS parent_name, r.r_name AS grandparent_name,
       'ES-' || code AS member_gid, 'ES-' || lpad(CAST(s.s_nationkey AS VARCHAR), 2, '0') AS parent_gid
FROM (SELECT *, lpad(CAST(n2.n_regionkey AS VARCHAR), 2, '0') || lpad(CAST(s_nationkey AS VARCHAR), 2, '0') ||
             lpad(CAST(s_suppkey % 1000 AS VARCHAR), 3, '0') || CAST(s_suppkey % 10 AS VARCHAR) AS code
      FROM supplier JOIN nation n2 ON s_nationkey = n2.n_nationkey) s
LEFT JOIN nation n ON s.s_nationkey = n.n_nationkey LEFT JOIN region r ON n.n_regionkey = r.r_regionkey""",
          ["M6", "S7", "S14", "S15", "J1", "U4"])
def m6(t: Tables):
    members = t.supplier.select(F.col("s_suppkey").alias("member_id"), F.col("s_name").alias("member_name"),
                                F.col("s_nationkey").alias("parent_id"), (F.col("s_suppkey") % 1000).alias("local_code"),
                                (F.col("s_suppkey") % 10).alias("check_digit"))
    parents = t.nation.select(F.col("n_nationkey").alias("parent_id"), F.col("n_name").alias("parent_name"),
                              F.col("n_regionkey").alias("grandparent_id"))
    grand = t.region.select(F.col("r_regionkey").alias("grandparent_id"), F.col("r_name").alias("grandparent_name"))
    return M.build_geo_dimension(members, parents, grand)


# Suppliers of some nations lie on islands: the island is the supplier key's last digit pair.
_CODE = "lpad(CAST(s_nationkey AS VARCHAR), 2, '0') || lpad(CAST(s_suppkey % 1000 AS VARCHAR), 3, '0') || CAST(s_suppkey % 10 AS VARCHAR)"
_ISLE = "lpad(CAST(s_nationkey AS VARCHAR), 2, '0') || lpad(CAST(s_suppkey % 4 AS VARCHAR), 2, '0')"


def _islands(t: Tables):
    s = t.supplier.filter(F.col("s_nationkey") < 8).join(t.nation, F.col("s_nationkey") == F.col("n_nationkey"))
    rows = s.select(F.col("s_nationkey").alias("parent_code"), (F.col("s_suppkey") % 1000).alias("local_code"),
                    (F.col("s_suppkey") % 10).alias("check_digit"), (F.col("s_suppkey") % 4).alias("island_code"),
                    F.concat(F.lit("Isla "), (F.col("s_suppkey") % 4).cast("string")).alias("island_name"), F.col("n_name").alias("parent_name"))
    members = m6(t).filter(F.col("member_id") % 5 != 0)  # some members are not in the dimension
    return M.build_island_tables(rows, members)


@register("m6_member_island_bridge", f"""
WITH d AS (SELECT DISTINCT {_CODE} AS partial_code, lpad(CAST(n_regionkey AS VARCHAR), 2, '0') || {_CODE} AS member_code
           FROM supplier JOIN nation ON s_nationkey = n_nationkey WHERE s_suppkey % 5 <> 0),
r AS (SELECT {_CODE} AS partial_code, {_ISLE} AS island_id, 'Isla ' || CAST(s_suppkey % 4 AS VARCHAR) AS island_name
      FROM supplier JOIN nation ON s_nationkey = n_nationkey WHERE s_nationkey < 8)
SELECT DISTINCT 'ES' AS country_id, member_code, r.partial_code, island_id, island_name, 'ES-' || island_id AS island_gid,
       'ES-' || member_code AS member_gid
FROM r LEFT JOIN d ON r.partial_code = d.partial_code""", ["M6", "J1", "U4"])
def m6_bridge(t: Tables):
    return _islands(t)[0]


@register("m6_island_dimension", f"""
SELECT DISTINCT 'ES' AS country_id, {_ISLE} AS island_id, 'Isla ' || CAST(s_suppkey % 4 AS VARCHAR) AS island_name,
       lpad(CAST(s_nationkey AS VARCHAR), 2, '0') AS parent_code, n_name AS parent_name, 'ES-' || {_ISLE} AS island_gid
FROM supplier JOIN nation ON s_nationkey = n_nationkey WHERE s_nationkey < 8""", ["M6", "U4"])
def m6_islands(t: Tables):
    return _islands(t)[1]
