"""Aggregations A1-A27 on the driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.common import round_half_up
from ..operators import aggregates as A
from ..operators.windows import running_diff
from ..tables import Tables
from . import standins as S
from .registry import register
from .sqlutil import r2


def _lines(t: Tables):
    return t.lineitem.select("l_orderkey", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount",
                             "l_returnflag", "l_linestatus", "l_shipdate")


@register("a1_group_means", f"""
SELECT l_returnflag, l_linestatus, CAST(month(l_shipdate) AS INTEGER) AS ship_month,
       {r2('AVG(l_extendedprice)')} AS avg_price, {r2('AVG(l_quantity)')} AS avg_qty
FROM lineitem GROUP BY 1, 2, 3""", ["A1", "N8"])
def a1(t: Tables):
    li = _lines(t).withColumn("ship_month", F.month("l_shipdate"))
    return A.group_means(li, ["l_returnflag", "l_linestatus", "ship_month"],
                         {"avg_price": "l_extendedprice", "avg_qty": "l_quantity"})


@register("a2_status_frequency", f"""
SELECT o_orderstatus, COUNT(*) AS n, {r2('COUNT(*) * 100.0 / SUM(COUNT(*)) OVER ()')} AS share_pct
FROM orders GROUP BY o_orderstatus""", ["A2"])
def a2(t: Tables):
    return A.frequency(t.orders.select("o_orderstatus"), "o_orderstatus")


@register("a3_global_counts", """
SELECT (SELECT COUNT(*) FROM region) AS regions, (SELECT COUNT(*) FROM nation) AS nations,
       (SELECT COUNT(*) FROM customer) AS customers, (SELECT COUNT(*) FROM supplier) AS suppliers""", ["A3"])
def a3(t: Tables):
    return A.global_counts({"regions": t.region, "nations": t.nation, "customers": t.customer, "suppliers": t.supplier})


_A4_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents")


@register("a4_table_counts", " UNION ALL ".join(
    f"SELECT '{n}' AS table_name, COUNT(*) AS n_rows FROM {n}" for n in _A4_TABLES), ["A4", "U2"])
def a4(t: Tables):
    return A.table_counts({n: getattr(t, n) for n in _A4_TABLES})


@register("a5_customers_per_nation", "SELECT c_nationkey, COUNT(*) AS n FROM customer GROUP BY c_nationkey", ["A5"])
def a5(t: Tables):
    return A.count_by(t.customer.select("c_nationkey"), "c_nationkey")


@register("a7_order_coverage", f"""
SELECT c.c_nationkey, COUNT(*) AS total, CAST(SUM(CASE WHEN o.c IS NOT NULL THEN 1 ELSE 0 END) AS BIGINT) AS with_match,
       CAST(SUM(CASE WHEN o.c IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS without_match,
       {r2('100.0 * SUM(CASE WHEN o.c IS NOT NULL THEN 1 ELSE 0 END) / NULLIF(COUNT(*), 0)')} AS coverage_pct
FROM customer c LEFT JOIN (SELECT DISTINCT o_custkey AS c FROM orders WHERE o_orderdate >= TIMESTAMP '2000-01-01') o
  ON c.c_custkey = o.c
GROUP BY c.c_nationkey""", ["A7"])
def a7(t: Tables):
    recent = t.orders.filter(F.col("o_orderdate") >= F.lit("2000-01-01").cast("timestamp_ntz")).select(
        F.col("o_custkey").alias("c")).distinct()
    c = t.customer.select("c_custkey", "c_nationkey").join(recent, F.col("c_custkey") == F.col("c"), "left")
    return A.coverage(c, ["c_nationkey"], F.col("c").isNotNull())


@register("a8_weekend_split", """
SELECT l_returnflag, COUNT(*) AS n_total, COUNT(*) FILTER (WHERE dayofweek(l_shipdate) IN (5, 6)) AS n_true,
       COUNT(*) FILTER (WHERE NOT dayofweek(l_shipdate) IN (5, 6)) AS n_false
FROM lineitem GROUP BY l_returnflag""", ["A8"])
def a8(t: Tables):
    return A.split_counts(_lines(t), ["l_returnflag"], F.dayofweek("l_shipdate").isin(6, 7))


@register("a9_lodging_summary_per_country", f"""
SELECT country_id, COUNT(*) AS n_rows, {r2('AVG(weekday_price)')} AS avg_weekday,
       {r2('AVG(weekend_price)')} AS avg_weekend, {r2('AVG((weekday_price + weekend_price) / 2)')} AS avg_mean_price
FROM ({S.LODGING_FACT_SQL}) f GROUP BY country_id""", ["A9", "A10"])
def a9(t: Tables):
    f = S.lodging_fact(t)
    return A.summary_per_key(f, ["country_id"], {
        "avg_weekday": "weekday_price", "avg_weekend": "weekend_price",
        "avg_mean_price": (F.col("weekday_price") + F.col("weekend_price")) / 2})


@register("a11_region_nation_rollup", f"""
SELECT country_id, province_id, {r2('SUM(total_spend)')} AS sum_total_spend, {r2('SUM(opinions)')} AS sum_opinions,
       {r2('AVG(entry_price)')} AS avg_entry_price, 'province_id' AS level
FROM ({S.ACTIVITY_FACT_SQL}) f GROUP BY country_id, province_id
UNION ALL
SELECT country_id, NULL, {r2('SUM(total_spend)')}, {r2('SUM(opinions)')}, {r2('AVG(entry_price)')}, 'country_id'
FROM ({S.ACTIVITY_FACT_SQL}) f GROUP BY country_id""", ["A11"])
def a11(t: Tables):
    f = S.activity_fact(t)
    return A.two_level_rollup(f, "country_id", "province_id", ["total_spend", "opinions"], ["entry_price"])


@register("a12_distinct_per_supplier", """
SELECT l_suppkey, COUNT(DISTINCT p_brand) AS n_brands, COUNT(DISTINCT p_type) AS n_types
FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY l_suppkey""", ["A12", "A27"])
def a12(t: Tables):
    j = _lines(t).join(t.part.select("p_partkey", "p_brand", "p_type"), F.col("l_partkey") == F.col("p_partkey"))
    return A.distinct_counts(j, ["l_suppkey"], {"n_brands": "p_brand", "n_types": "p_type"})


@register("a13_status_text_per_customer", """
SELECT o_custkey, STRING_AGG(o_orderstatus || ' (' || CAST(n AS VARCHAR) || ')', ', ' ORDER BY o_orderstatus) AS labels
FROM (SELECT o_custkey, o_orderstatus, COUNT(*) AS n FROM orders GROUP BY 1, 2) z GROUP BY o_custkey""", ["A13"])
def a13(t: Tables):
    c = t.orders.groupBy("o_custkey", "o_orderstatus").agg(F.count(F.lit(1)).alias("n"))
    return A.ordered_string_agg(c, ["o_custkey"], "o_orderstatus", "n")


@register("a14_mode_flag_per_supplier", """
SELECT l_suppkey, l_returnflag AS mode_l_returnflag FROM (
  SELECT l_suppkey, l_returnflag, ROW_NUMBER() OVER (PARTITION BY l_suppkey ORDER BY COUNT(*) DESC, l_returnflag) rn
  FROM lineitem GROUP BY 1, 2) z WHERE rn = 1""", ["A14"])
def a14(t: Tables):
    return A.group_mode(_lines(t), ["l_suppkey"], "l_returnflag")


@register("a15_first_order_per_customer", """
SELECT o_custkey, arg_min(o_orderkey, (o_orderdate, o_orderkey)) AS first_o_orderkey FROM orders GROUP BY o_custkey""",
          ["A15"])
def a15(t: Tables):
    return A.first_by_order(t.orders, ["o_custkey"], "o_orderkey", ["o_orderdate", "o_orderkey"])


@register("a16_quantiles_by_nation", f"""
SELECT s_nationkey, {r2('quantile_cont(l_extendedprice, 0.25)')} AS p25, {r2('median(l_extendedprice)')} AS p50,
       {r2('quantile_cont(l_extendedprice, 0.75)')} AS p75
FROM lineitem JOIN supplier ON l_suppkey = s_suppkey GROUP BY s_nationkey""", ["A16", "R4"])
def a16(t: Tables):
    j = _lines(t).join(t.supplier.select("s_suppkey", "s_nationkey"), F.col("l_suppkey") == F.col("s_suppkey"))
    return A.group_quantiles(j, ["s_nationkey"], "l_extendedprice", {"p25": 0.25, "p50": 0.5, "p75": 0.75})


@register("a17_global_quantile_table", " UNION ALL ".join(
    f"SELECT CAST({p} AS DOUBLE) AS prob, {r2(f'quantile_cont(l_extendedprice, {p})')} AS value FROM lineitem"
    for p in (0.05, 0.25, 0.5, 0.75, 0.95, 0.99)), ["A17"])
def a17(t: Tables):
    return A.global_quantiles(_lines(t), "l_extendedprice", [0.05, 0.25, 0.5, 0.75, 0.95, 0.99])


@register("a18_two_stage_median", f"""
SELECT ship_month, {r2('median(m)')} AS median_of_medians FROM (
  SELECT s_nationkey, CAST(month(l_shipdate) AS INTEGER) AS ship_month, median(l_extendedprice) AS m
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey GROUP BY 1, 2) z GROUP BY ship_month""", ["A18"])
def a18(t: Tables):
    j = (_lines(t).join(t.supplier.select("s_suppkey", "s_nationkey"), F.col("l_suppkey") == F.col("s_suppkey"))
         .withColumn("ship_month", F.month("l_shipdate")))
    return A.two_stage_median(j, ["s_nationkey", "ship_month"], ["ship_month"], "l_extendedprice")


@register("a19_numeric_profile", f"""
SELECT l_returnflag, COUNT(l_extendedprice) AS count, {r2('AVG(l_extendedprice)')} AS mean,
       {r2('STDDEV_SAMP(l_extendedprice)')} AS std, {r2('MIN(l_extendedprice)')} AS min,
       {r2('quantile_cont(l_extendedprice, 0.25)')} AS p25, {r2('quantile_cont(l_extendedprice, 0.5)')} AS p50,
       {r2('quantile_cont(l_extendedprice, 0.75)')} AS p75, {r2('MAX(l_extendedprice)')} AS max
FROM lineitem GROUP BY l_returnflag""", ["A19"])
def a19(t: Tables):
    return A.numeric_profile(_lines(t), "l_extendedprice", ["l_returnflag"])


@register("a20_correlation", f"""
SELECT l_returnflag, {r2('CORR(l_extendedprice, l_discount)', 4)} AS pearson_r FROM lineitem
WHERE l_extendedprice IS NOT NULL AND l_discount IS NOT NULL GROUP BY l_returnflag""", ["A20"])
def a20(t: Tables):
    return A.correlation(_lines(t), "l_extendedprice", "l_discount", ["l_returnflag"])


_CM_COLS = ("l_quantity", "l_extendedprice", "l_discount")


@register("a20_correlation_matrix", " UNION ALL ".join(
    f"SELECT '{a}' AS x, '{b}' AS y, {r2(f'CORR({a}, {b})', 4)} AS r FROM lineitem" for a in _CM_COLS for b in _CM_COLS),
    ["A20"])
def a20m(t: Tables):
    return A.correlation_matrix(_lines(t), list(_CM_COLS))


@register("a21_share_discounted", f"""
SELECT l_linestatus, {r2('AVG(CASE WHEN COALESCE(l_discount >= 0.05, FALSE) THEN 1 ELSE 0 END) * 100')} AS share_pct
FROM lineitem GROUP BY l_linestatus""", ["A21"])
def a21(t: Tables):
    return A.share_true(_lines(t), F.col("l_discount") >= 0.05, ["l_linestatus"])


@register("a22_daily_to_period", f"""
SELECT event_type, strftime(ts, '%Y-%m-%d') AS period, {r2('AVG(value)')} AS avg_value, {r2('SUM(value)')} AS sum_value
FROM events GROUP BY 1, 2""", ["A22", "D-7"])
def a22(t: Tables):
    return A.period_rollup(t.events, ["event_type"], "ts", "yyyy-MM-dd", means=["value"], sums=["value"])


@register("a23_lines_per_order_profile", f"""
SELECT COUNT(group_size) AS count, {r2('AVG(group_size)')} AS mean, {r2('STDDEV_SAMP(group_size)')} AS std,
       {r2('MIN(group_size)')} AS min, {r2('quantile_cont(group_size, 0.25)')} AS p25,
       {r2('quantile_cont(group_size, 0.5)')} AS p50, {r2('quantile_cont(group_size, 0.75)')} AS p75,
       {r2('MAX(group_size)')} AS max
FROM (SELECT CAST(COUNT(*) AS DOUBLE) AS group_size FROM lineitem GROUP BY l_orderkey) z""", ["A23", "A19"])
def a23(t: Tables):
    return A.group_size_profile(_lines(t), ["l_orderkey"])


@register("a24_w9_scenario_compare", f"""
WITH s AS (
  SELECT 1 AS scenario_pos, 'all_rows' AS scenario, COUNT(*) AS n_rows, {r2('AVG(l_extendedprice)')} AS avg_price,
         {r2('AVG(l_discount)')} AS avg_discount FROM lineitem
  UNION ALL
  SELECT 2, 'without_returns', COUNT(*) FILTER (WHERE l_returnflag <> 'R'),
         {r2("AVG(CASE WHEN l_returnflag <> 'R' THEN l_extendedprice END)")},
         {r2("AVG(CASE WHEN l_returnflag <> 'R' THEN l_discount END)")} FROM lineitem)
SELECT *, avg_price - LAG(avg_price) OVER (ORDER BY scenario_pos) AS diff_avg_price FROM s""", ["A24", "W9"])
def a24(t: Tables):
    li = _lines(t)
    sc = A.scenario_compare(li, {"all_rows": F.lit(True), "without_returns": F.col("l_returnflag") != "R"},
                            {"avg_price": "l_extendedprice", "avg_discount": "l_discount"})
    return running_diff(sc.withColumn("series", F.lit(1)), "scenario_pos", "avg_price", ["series"]).drop("series")


@register("a25_ledger_totals", f"""
SELECT user_id AS plan_id, event_type AS category, {r2('SUM(value)')} AS total, COUNT(*) AS n
FROM events GROUP BY 1, 2""", ["A25"])
def a25(t: Tables):
    return A.totals_per_key(S.ledger(t), ["plan_id", "category"], "amount")


@register("a26_null_share", f"""
SELECT l_returnflag, {r2('AVG(CASE WHEN (CASE WHEN l_orderkey % 7 = 0 THEN NULL ELSE l_extendedprice END) IS NULL THEN 1 ELSE 0 END) * 100')} AS null_pct_price
FROM lineitem GROUP BY l_returnflag""", ["A26"])
def a26(t: Tables):
    li = _lines(t).withColumn("price", F.when(F.col("l_orderkey") % 7 != 0, F.col("l_extendedprice")))
    return A.null_share(li, ["l_returnflag"], "price", out="null_pct_price")


@register("a27_customers_per_nation_distinct", """
SELECT c_nationkey, COUNT(DISTINCT o_custkey) AS n_active, COUNT(DISTINCT o_orderstatus) AS n_statuses
FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY c_nationkey""", ["A27", "A12"])
def a27(t: Tables):
    j = t.orders.join(t.customer.select("c_custkey", "c_nationkey"), F.col("o_custkey") == F.col("c_custkey"))
    return A.distinct_counts(j, ["c_nationkey"], {"n_active": "o_custkey", "n_statuses": "o_orderstatus"})
