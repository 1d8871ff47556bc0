"""Projections and filters (F1-F4, F11-F13) and join helpers (J2, J9,
J12) on the driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.common import null_safe_not_in, round_half_up
from ..operators import joins as J
from ..tables import Tables
from . import standins as S
from .registry import register
from .sqlutil import r2

# Sentinel rows removed from category lists.
SENTINEL_LABELS = ("total nacional", "total", "otros", "no aplica")


@register("f2_sentinel_and_set_filter", """
SELECT o_orderkey, label FROM (
  SELECT o_orderkey, CASE WHEN o_orderkey % 9 = 0 THEN 'Total' WHEN o_orderkey % 9 = 1 THEN NULL ELSE o_orderpriority END AS label
  FROM orders) z
WHERE NOT COALESCE(lower(trim(label)) IN ('total nacional', 'total', 'otros', 'no aplica'), FALSE)""", ["F2"])
def f2(t: Tables):
    o = t.orders.select("o_orderkey", F.when(F.col("o_orderkey") % 9 == 0, F.lit("Total"))
                        .when(F.col("o_orderkey") % 9 != 1, F.col("o_orderpriority")).alias("label"))
    return o.filter(null_safe_not_in(F.lower(F.trim("label")), SENTINEL_LABELS))


@register("f3_f4_range_and_required", """
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_discount FROM lineitem
WHERE l_discount BETWEEN 0.02 AND 0.08 AND l_quantity BETWEEN 10 AND 40 AND l_returnflag IS NOT NULL AND l_returnflag <> ''""",
          ["F3", "F4"])
def f3(t: Tables):
    li = t.lineitem.select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_discount", "l_returnflag")
    li = li.dropna(subset=["l_returnflag"]).filter(F.col("l_returnflag") != "")
    return li.filter(F.col("l_discount").between(0.02, 0.08) & F.col("l_quantity").between(10, 40)).drop("l_returnflag")


@register("f12_f13_presence_flag_zero_fill", f"""
SELECT c.c_custkey, r.v IS NOT NULL AS has_orders, COALESCE(r.v, 0.0) AS total_zero_filled, r.v AS total
FROM customer c LEFT JOIN (SELECT o_custkey, {r2('SUM(o_totalprice)')} AS v FROM orders WHERE o_orderstatus = 'F' GROUP BY 1) r
ON c.c_custkey = r.o_custkey""", ["F12", "F13", "J1"])
def f12(t: Tables):
    tot = (t.orders.filter(F.col("o_orderstatus") == "F").groupBy("o_custkey")
           .agg(round_half_up(F.sum("o_totalprice")).alias("total")))
    j = t.customer.select("c_custkey").join(tot, F.col("c_custkey") == F.col("o_custkey"), "left")
    flag = F.col("total").isNotNull()
    return j.select("c_custkey", flag.alias("has_orders"),
                    F.when(~flag, F.lit(0.0)).otherwise(F.col("total")).alias("total_zero_filled"), "total")


@register("j2_inner_fact_dimension", f"""
SELECT l.l_orderkey, l.l_linenumber, l.l_partkey, s.s_name, {r2('l.l_extendedprice')} AS price
FROM lineitem l JOIN supplier s ON l.l_suppkey = s.s_suppkey WHERE s.s_acctbal > 0""", ["J2"])
def j2(t: Tables):
    s = t.supplier.filter(F.col("s_acctbal") > 0).select("s_suppkey", "s_name")
    li = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")
    j = J.lookup_join(li, s, li.l_suppkey == s.s_suppkey, "inner")
    return j.select("l_orderkey", "l_linenumber", "l_partkey", "s_name", round_half_up("l_extendedprice").alias("price"))


@register("j9_validated_many_to_one", """
SELECT c.c_custkey, n.n_name FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey""", ["J9"])
def j9(t: Tables):
    c = t.customer.select("c_custkey", F.col("c_nationkey").alias("k"))
    n = t.nation.select(F.col("n_nationkey").alias("k"), "n_name")
    J.assert_join_cardinality(c, n, ["k"], "m:1")  # nation keys are unique: passes
    return c.join(n, "k").select("c_custkey", "n_name")


@register("j12_left_join_chain", f"""
SELECT o.o_orderkey, COALESCE(a.n_lines, 0) AS n_lines, COALESCE(b.revenue, 0) AS revenue, COALESCE(c.n_returns, 0) AS n_returns
FROM orders o
LEFT JOIN (SELECT l_orderkey AS o_orderkey, COUNT(*) AS n_lines FROM lineitem GROUP BY 1) a ON o.o_orderkey = a.o_orderkey
LEFT JOIN (SELECT l_orderkey AS o_orderkey, {r2('SUM(l_extendedprice * (1 - l_discount))')} AS revenue FROM lineitem GROUP BY 1) b
  ON o.o_orderkey = b.o_orderkey
LEFT JOIN (SELECT l_orderkey AS o_orderkey, COUNT(*) AS n_returns FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1) c
  ON o.o_orderkey = c.o_orderkey""", ["J12"])
def j12(t: Tables):
    li = t.lineitem.select(F.col("l_orderkey").alias("o_orderkey"), "l_extendedprice", "l_discount", "l_returnflag")
    # The parts have one key and one source: one conditional aggregate.
    part = li.groupBy("o_orderkey").agg(
        F.count(F.lit(1)).alias("n_lines"), round_half_up(F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount")))).alias("revenue"),
        F.count_if(F.col("l_returnflag") == "R").alias("n_returns"))
    out = J.left_join_chain(t.orders.select("o_orderkey"), [part], "o_orderkey", zero_fill=["n_lines", "n_returns"])
    return out.withColumn("revenue", F.coalesce(F.col("revenue"), F.lit(0.0)))


@register("a6_region_detail_zero_filled", """
SELECT r.r_regionkey, r.r_name, COALESCE(n.c, 0) AS n_nations, COALESCE(cu.c, 0) AS n_customers, COALESCE(su.c, 0) AS n_suppliers
FROM region r
LEFT JOIN (SELECT n_regionkey, COUNT(*) AS c FROM nation WHERE n_nationkey % 2 = 0 GROUP BY 1) n ON r.r_regionkey = n.n_regionkey
LEFT JOIN (SELECT n_regionkey, COUNT(*) AS c FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE c_acctbal > 9000 GROUP BY 1) cu
  ON r.r_regionkey = cu.n_regionkey
LEFT JOIN (SELECT n_regionkey, COUNT(*) AS c FROM supplier JOIN nation ON s_nationkey = n_nationkey WHERE s_acctbal > 9500 GROUP BY 1) su
  ON r.r_regionkey = su.n_regionkey""", ["A6", "J15"])
def a6(t: Tables):
    n = t.nation.select("n_nationkey", "n_regionkey")
    cust = t.customer.filter(F.col("c_acctbal") > 9000).join(n, F.col("c_nationkey") == F.col("n_nationkey"))
    supp = t.supplier.filter(F.col("s_acctbal") > 9500).join(n, F.col("s_nationkey") == F.col("n_nationkey"))
    return J.counts_per_parent(t.region.select("r_regionkey", "r_name"), "r_regionkey", {
        "n_nations": (n.filter(F.col("n_nationkey") % 2 == 0), "n_regionkey"),
        "n_customers": (cust.select("n_regionkey"), "n_regionkey"),
        "n_suppliers": (supp.select("n_regionkey"), "n_regionkey")})
