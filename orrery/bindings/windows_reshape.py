"""Window operators (W1-W12), reshape (R1-R5) and top-k."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.common import round_half_up
from ..operators import reshape as R
from ..operators import topk as T
from ..operators import windows as W
from ..tables import Tables
from . import standins as S
from .registry import register
from .sqlutil import r2


def _priced_lines(t: Tables):
    li = t.lineitem.select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_shipdate", "l_quantity",
                           "l_extendedprice")
    s = t.supplier.select("s_suppkey", "s_nationkey")
    j = li.join(s, F.col("l_suppkey") == F.col("s_suppkey"))
    return j.select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_shipdate", "l_quantity", "s_nationkey",
                    F.month("l_shipdate").alias("ship_month"),
                    F.when(F.col("l_orderkey") % 7 != 0, F.col("l_extendedprice")).alias("price"))


W1_SQL = f"""
WITH b AS (SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_shipdate, l_quantity, s_nationkey,
                  CAST(month(l_shipdate) AS INTEGER) AS ship_month,
                  CASE WHEN l_orderkey % 7 = 0 THEN NULL ELSE l_extendedprice END AS price
           FROM lineitem JOIN supplier ON l_suppkey = s_suppkey),
f1 AS (SELECT *, COALESCE(price, AVG(price) OVER (PARTITION BY s_nationkey, l_suppkey, ship_month)) AS p1 FROM b),
f2 AS (SELECT *, COALESCE(p1, AVG(p1) OVER (PARTITION BY s_nationkey, l_suppkey)) AS p2 FROM f1),
f3 AS (SELECT *, COALESCE(p2, AVG(p2) OVER (PARTITION BY s_nationkey)) AS p3 FROM f2),
f4 AS (SELECT *, COALESCE(p3, AVG(p3) OVER ()) AS p4 FROM f3)
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_shipdate, l_quantity, {r2('p4')} AS price_filled,
  CASE WHEN price IS NOT NULL THEN 'observed' WHEN p1 IS NOT NULL THEN 'level_1' WHEN p2 IS NOT NULL THEN 'level_2'
       WHEN p3 IS NOT NULL THEN 'level_3' ELSE 'global' END AS fill_level
FROM f4"""


@register("w1_impute_hierarchical", W1_SQL, ["W1"])
def w1(t: Tables):
    li = _priced_lines(t)
    f = W.impute_hierarchical(li, "price", [["s_nationkey", "l_suppkey", "ship_month"], ["s_nationkey", "l_suppkey"],
                                            ["s_nationkey"]], out="price_filled", level_col="fill_level")
    return f.select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_shipdate", "l_quantity",
                    round_half_up("price_filled").alias("price_filled"), "fill_level")


_REV_SQL = """SELECT n_regionkey, n_nationkey, SUM(l_extendedprice * (1 - l_discount)) AS revenue
FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey GROUP BY 1, 2"""


def _revenue(t: Tables):
    li = t.lineitem.select("l_suppkey", "l_extendedprice", "l_discount")
    j = li.join(t.supplier.select("s_suppkey", "s_nationkey"), F.col("l_suppkey") == F.col("s_suppkey")).join(
        t.nation.select("n_nationkey", "n_regionkey"), F.col("s_nationkey") == F.col("n_nationkey"))
    return j.groupBy("n_regionkey", "n_nationkey").agg(
        F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("revenue"))


@register("w2_revenue_share_in_region", f"""
SELECT n_regionkey, n_nationkey, {r2('revenue')} AS revenue, {r2('revenue / SUM(revenue) OVER (PARTITION BY n_regionkey) * 100')} AS share_pct
FROM ({_REV_SQL}) r""", ["W2"])
def w2(t: Tables):
    s = W.share_within(_revenue(t), ["n_regionkey"], "revenue")
    return s.withColumn("revenue", round_half_up("revenue"))


@register("w3_top_brand_per_nation", f"""
SELECT s_nationkey, p_brand, {r2('rev')} AS revenue FROM (
  SELECT s_nationkey, p_brand, SUM(l_extendedprice) AS rev,
         ROW_NUMBER() OVER (PARTITION BY s_nationkey ORDER BY SUM(l_extendedprice) DESC, p_brand) AS rn
  FROM lineitem JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey GROUP BY 1, 2) z
WHERE rn = 1""", ["W3", "W4"])
def w3(t: Tables):
    j = (t.lineitem.select("l_partkey", "l_suppkey", "l_extendedprice")
         .join(t.part.select("p_partkey", "p_brand"), F.col("l_partkey") == F.col("p_partkey"))
         .join(t.supplier.select("s_suppkey", "s_nationkey"), F.col("l_suppkey") == F.col("s_suppkey")))
    g = j.groupBy("s_nationkey", "p_brand").agg(F.sum("l_extendedprice").alias("rev"))
    top = W.first_row_per_group(g, ["s_nationkey"], [-F.col("rev"), F.col("p_brand")])
    return top.select("s_nationkey", "p_brand", round_half_up("rev").alias("revenue"))


@register("w3_top3_brands_per_nation", f"""
SELECT s_nationkey, p_brand, {r2('rev')} AS revenue, CAST(rn AS INTEGER) AS brand_rank FROM (
  SELECT s_nationkey, p_brand, SUM(l_extendedprice) AS rev,
         ROW_NUMBER() OVER (PARTITION BY s_nationkey ORDER BY SUM(l_extendedprice) DESC, p_brand) AS rn
  FROM lineitem JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey GROUP BY 1, 2) z
WHERE rn <= 3""", ["W3", "T2"])
def w3k(t: Tables):
    j = (t.lineitem.select("l_partkey", "l_suppkey", "l_extendedprice")
         .join(t.part.select("p_partkey", "p_brand"), F.col("l_partkey") == F.col("p_partkey"))
         .join(t.supplier.select("s_suppkey", "s_nationkey"), F.col("l_suppkey") == F.col("s_suppkey")))
    g = j.groupBy("s_nationkey", "p_brand").agg(F.sum("l_extendedprice").alias("rev"))
    top = W.top_per_group(g, ["s_nationkey"], [F.col("rev").desc(), F.col("p_brand").asc()], k=3, rank_col="brand_rank")
    return top.select("s_nationkey", "p_brand", round_half_up("rev").alias("revenue"), "brand_rank")


_MONTHLY_SQL = "SELECT CAST(month(l_shipdate) AS INTEGER) AS ship_month, AVG(l_extendedprice) AS avg_price FROM lineitem GROUP BY 1"


@register("w5_peak_and_low_month", f"""
SELECT arg_min(ship_month, (-avg_price, ship_month)) AS peak_label, {r2('MAX(avg_price)')} AS peak_value,
       arg_min(ship_month, (avg_price, ship_month)) AS low_label, {r2('MIN(avg_price)')} AS low_value,
       {r2('MAX(avg_price) - MIN(avg_price)')} AS amplitude
FROM ({_MONTHLY_SQL}) m""", ["W5", "M8"])
def w5(t: Tables):
    m = t.lineitem.groupBy(F.month("l_shipdate").alias("ship_month")).agg(F.avg("l_extendedprice").alias("avg_price"))
    return W.extremes(m, "ship_month", "avg_price")


@register("w6_year_over_year", f"""
SELECT l_returnflag, yr, {r2('rev')} AS revenue,
       {r2('(rev - LAG(rev) OVER (PARTITION BY l_returnflag ORDER BY yr)) / NULLIF(LAG(rev) OVER (PARTITION BY l_returnflag ORDER BY yr), 0) * 100')} AS pct_change
FROM (SELECT l_returnflag, CAST(year(l_shipdate) AS INTEGER) AS yr, SUM(l_extendedprice) AS rev FROM lineitem GROUP BY 1, 2) z""",
          ["W6", "M21"])
def w6(t: Tables):
    g = t.lineitem.groupBy("l_returnflag", F.year("l_shipdate").alias("yr")).agg(F.sum("l_extendedprice").alias("rev"))
    return W.period_change(g, ["l_returnflag"], "yr", "rev").select(
        "l_returnflag", "yr", round_half_up("rev").alias("revenue"), "pct_change")


@register("w7_minmax_normalize", f"""
SELECT s_suppkey, {r2('(s_acctbal - lo) / NULLIF(hi - lo, 0)', 6)} AS balance_norm,
       {r2('1 - (s_acctbal - lo) / NULLIF(hi - lo, 0)', 6)} AS balance_inv
FROM supplier, (SELECT MIN(s_acctbal) AS lo, MAX(s_acctbal) AS hi FROM supplier) m""", ["W7"])
def w7(t: Tables):
    s = t.supplier.select("s_suppkey", "s_acctbal")
    s = W.minmax_normalize(s, "s_acctbal", "balance_norm")
    s = W.minmax_normalize(s, "s_acctbal", "balance_inv", invert=True)
    return s.select("s_suppkey", round_half_up("balance_norm", 6).alias("balance_norm"),
                    round_half_up("balance_inv", 6).alias("balance_inv"))


@register("w8_winsorized_normalize", f"""
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_shipdate,
       {r2('(LEAST(GREATEST(l_extendedprice, lo), hi) - lo) / NULLIF(hi - lo, 0)', 6)} AS price_wnorm
FROM lineitem, (SELECT quantile_cont(l_extendedprice, 0.05) AS lo, quantile_cont(l_extendedprice, 0.95) AS hi FROM lineitem) q""",
          ["W8"])
def w8(t: Tables):
    li = t.lineitem.select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_shipdate", "l_extendedprice")
    w = W.winsorized_normalize(li, "l_extendedprice", out="price_wnorm")
    return w.select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_shipdate",
                    round_half_up("price_wnorm", 6).alias("price_wnorm"))


@register("w12_priority_mix_by_month", f"""
SELECT m, o_orderpriority, n, {r2('n * 100.0 / SUM(n) OVER (PARTITION BY m)')} AS share_pct
FROM (SELECT CAST(month(o_orderdate) AS INTEGER) AS m, o_orderpriority, COUNT(*) AS n FROM orders GROUP BY 1, 2) z""",
          ["W12", "W2", "M24"])
def w12(t: Tables):
    g = t.orders.groupBy(F.month("o_orderdate").alias("m"), "o_orderpriority").agg(F.count(F.lit(1)).alias("n"))
    return W.share_within(g, ["m"], "n")


_TYPES = ("ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD")
_REGIONS = ("AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST")
_REG_COLS = [r.lower().replace(" ", "_") for r in _REGIONS]
_TYPE_REGION_SQL = """FROM lineitem JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey
JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey"""


def _type_region(t: Tables):
    return (t.lineitem.select("l_partkey", "l_suppkey", "l_extendedprice", "l_shipdate")
            .join(t.part.select("p_partkey", "p_type"), F.col("l_partkey") == F.col("p_partkey"))
            .join(t.supplier.select("s_suppkey", "s_nationkey"), F.col("l_suppkey") == F.col("s_suppkey"))
            .join(t.nation.select("n_nationkey", "n_regionkey"), F.col("s_nationkey") == F.col("n_nationkey"))
            .join(t.region, F.col("n_regionkey") == F.col("r_regionkey")))


@register("r1_pivot_sum", "SELECT p_type, " + ", ".join(
    f"{r2(f'COALESCE(SUM(CASE WHEN r_name = {chr(39)}{r}{chr(39)} THEN l_extendedprice END), 0.0)')} AS {c}"
    for r, c in zip(_REGIONS, _REG_COLS)) + ", " + r2(" + ".join(
        f"COALESCE(SUM(CASE WHEN r_name = '{r}' THEN l_extendedprice END), 0.0)" for r in _REGIONS)) +
    " AS total " + _TYPE_REGION_SQL + " GROUP BY p_type", ["R1", "T1"])
def r1(t: Tables):
    return R.pivot_sum(_type_region(t), ["p_type"], "r_name", _REGIONS, "l_extendedprice", names=_REG_COLS)


@register("r2_pivot_mean", "SELECT r_name, " + ", ".join(
    f"{r2(f'AVG(CASE WHEN month(l_shipdate) = {m} THEN l_extendedprice END)')} AS m{m:02d}" for m in range(1, 13)) +
    " " + _TYPE_REGION_SQL + " GROUP BY r_name", ["R2", "M23"])
def r2_(t: Tables):
    d = _type_region(t).withColumn("m", F.month("l_shipdate"))
    return R.pivot_mean(d, ["r_name"], "m", list(range(1, 13)), "l_extendedprice",
                        names=[f"m{m:02d}" for m in range(1, 13)])


_YEARS = list(range(1995, 2002))


@register("r3_pivot_shares", f"""
WITH c AS (SELECT o_orderstatus, CAST(year(o_orderdate) AS INTEGER) AS yr, COUNT(*) AS n FROM orders GROUP BY 1, 2),
s AS (SELECT o_orderstatus, yr, {r2('n * 100.0 / SUM(n) OVER (PARTITION BY yr)')} AS share_pct FROM c)
SELECT o_orderstatus, """ + ", ".join(f"MAX(CASE WHEN yr = {y} THEN share_pct END) AS y{y}" for y in _YEARS) +
          " FROM s GROUP BY o_orderstatus", ["R3", "W2"])
def r3(t: Tables):
    c = t.orders.groupBy("o_orderstatus", F.year("o_orderdate").alias("yr")).agg(F.count(F.lit(1)).alias("n"))
    s = W.share_within(c, ["yr"], "n")
    return R.pivot_first(s, ["o_orderstatus"], "yr", _YEARS, "share_pct", names=[f"y{y}" for y in _YEARS])


@register("r5_unpivot_components", f"""
SELECT s_suppkey, category, amount FROM (
  SELECT s_suppkey, 'balance' AS category, s_acctbal AS amount FROM supplier
  UNION ALL SELECT s_suppkey, 'nation', CAST(s_nationkey AS DOUBLE) FROM supplier) z""", ["R5"])
def r5(t: Tables):
    s = t.supplier.select("s_suppkey", F.col("s_acctbal").alias("balance"), F.col("s_nationkey").cast("double").alias("nation"))
    return R.unpivot(s, ["s_suppkey"], ["balance", "nation"])


@register("t2_top_nations_by_revenue", f"""
SELECT n_nationkey, {r2('revenue')} AS revenue FROM ({_REV_SQL}) r ORDER BY revenue DESC, n_nationkey LIMIT 5""",
          ["T2", "T1"])
def t2(t: Tables):
    top = T.top_n(_revenue(t), [F.col("revenue").desc()], 5, tiebreak=["n_nationkey"])
    return top.select("n_nationkey", round_half_up("revenue").alias("revenue"))


@register("t3_cheapest_and_dearest_months", f"""
SELECT ship_month, {r2('avg_price')} AS avg_price, side, CAST(rk AS INTEGER) AS rank FROM (
  SELECT *, 'low' AS side, ROW_NUMBER() OVER (ORDER BY avg_price, ship_month) AS rk FROM ({_MONTHLY_SQL}) a
  UNION ALL
  SELECT *, 'high', ROW_NUMBER() OVER (ORDER BY avg_price DESC, ship_month) FROM ({_MONTHLY_SQL}) b) z WHERE rk <= 3""",
          ["T3"])
def t3(t: Tables):
    m = t.lineitem.groupBy(F.month("l_shipdate").alias("ship_month")).agg(F.avg("l_extendedprice").alias("avg_price"))
    b = T.bottom_and_top(m, "avg_price", 3, tiebreak=["ship_month"])
    return b.select("ship_month", round_half_up("avg_price").alias("avg_price"), "side", "rank")


@register("t4_cheapest_provinces_for_category", f"""
SELECT country_id, province_id, province_name, category, avg_price FROM (
  SELECT f.country_id, f.province_id, p.province_name, f.category,
         {r2('AVG((f.weekday_price + f.weekend_price) / 2)')} AS avg_price
  FROM ({S.LODGING_FACT_SQL}) f JOIN ({S.PROVINCES_SQL}) p ON f.province_id = p.province_id
  GROUP BY 1, 2, 3, 4) z
WHERE category = 'R' AND avg_price IS NOT NULL ORDER BY avg_price, province_id LIMIT 10""", ["T4", "T2", "M1"])
def t4(t: Tables):
    from ..plans.recipes import price_by_province
    rec = price_by_province(S.lodging_fact(t), S.provinces(t))
    rec = rec.filter((F.col("category") == "R") & F.col("avg_price").isNotNull())
    return T.top_n(rec, [F.col("avg_price").asc()], 10, tiebreak=["province_id"]).select(
        "country_id", "province_id", "province_name", "category", "avg_price")


@register("t4_provinces_with_most_options", f"""
SELECT province_id, CAST(SUM(n_rows) AS BIGINT) AS n_options FROM (
  SELECT province_id, category, COUNT(*) AS n_rows FROM ({S.ACTIVITY_FACT_SQL}) f GROUP BY 1, 2) z
WHERE category IN ('PROMO', 'SMALL') GROUP BY province_id ORDER BY n_options DESC, province_id LIMIT 10""", ["T4"])
def t4b(t: Tables):
    f = S.activity_fact(t).filter(F.col("category").isin("PROMO", "SMALL"))
    g = f.groupBy("province_id").agg(F.count(F.lit(1)).alias("n_options"))
    return T.top_n(g, [F.col("n_options").desc()], 10, tiebreak=["province_id"])


@register("t6_brands_by_unprojected_revenue", """
SELECT p_brand FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY p_brand""", ["T6", "P19"])
def t6(t: Tables):
    j = t.lineitem.select("l_partkey", "l_extendedprice").join(t.part.select("p_partkey", "p_brand"),
                                                                 F.col("l_partkey") == F.col("p_partkey"))
    return T.keys_by_aggregate(j, "p_brand", F.sum("l_extendedprice"))


@register("t7_capped_listing", """
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_extendedprice FROM lineitem
ORDER BY l_extendedprice DESC, l_orderkey, l_partkey, l_suppkey, l_linenumber, l_shipdate, l_quantity LIMIT 8000""",
          ["T7", "T5"])
def t7(t: Tables):
    li = t.lineitem.select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_extendedprice", "l_shipdate",
                           "l_quantity")
    top = T.top_n(li, [F.col("l_extendedprice").desc()], 8000,
                  tiebreak=["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_shipdate", "l_quantity"])
    return top.select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_extendedprice")
