"""Joins (J4-J15), duplicates (K1-K5), set operations (U1-U4) and
surrogate keys (W10, W11) on the driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import joins as J
from ..operators import keys as K
from ..tables import Tables
from . import standins as S
from .registry import register
from .sqlutil import r2

LINE_COLS = ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
             "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate")
LINE_ORDER = ("l_shipdate", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
              "l_returnflag", "l_linestatus")
_ORDER_SQL = ", ".join(LINE_ORDER)


@register("j1_supplier_nation_region", """
SELECT s.s_suppkey, s.s_name, n.n_name, r.r_name FROM supplier s
LEFT JOIN nation n ON s.s_nationkey = n.n_nationkey LEFT JOIN region r ON n.n_regionkey = r.r_regionkey""",
          ["J1", "F1"])
def j1(t: Tables):
    s = t.supplier.select("s_suppkey", "s_name", "s_nationkey")
    n = t.nation.select(F.col("n_nationkey").alias("s_nationkey"), "n_name", "n_regionkey")
    r = t.region.select(F.col("r_regionkey").alias("n_regionkey"), "r_name")
    return (J.lookup_join(J.lookup_join(s, n, "s_nationkey"), r, "n_regionkey")
            .select("s_suppkey", "s_name", "n_name", "r_name"))


@register("j3_order_two_nation_roles", """
SELECT o.o_orderkey, cn.n_name AS customer_nation, sn.n_name AS supplier_nation
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
JOIN (SELECT l_orderkey, MIN(l_suppkey) AS first_supp FROM lineitem GROUP BY l_orderkey) f ON f.l_orderkey = o.o_orderkey
JOIN supplier s ON s.s_suppkey = f.first_supp
JOIN nation cn ON cn.n_nationkey = c.c_nationkey JOIN nation sn ON sn.n_nationkey = s.s_nationkey""", ["J3", "J2"])
def j3(t: Tables):
    o = t.orders.select("o_orderkey", "o_custkey")
    c = t.customer.select(F.col("c_custkey").alias("o_custkey"), F.col("c_nationkey").alias("cust_nation"))
    f = t.lineitem.groupBy("l_orderkey").agg(F.min("l_suppkey").alias("first_supp"))
    s = t.supplier.select(F.col("s_suppkey").alias("first_supp"), F.col("s_nationkey").alias("supp_nation"))
    base = (o.join(c, "o_custkey").join(f.withColumnRenamed("l_orderkey", "o_orderkey"), "o_orderkey")
            .join(s, "first_supp"))
    nat = t.nation.select("n_nationkey", "n_name")
    out = J.role_join(base, nat, "n_nationkey", {"cust_nation": "cn", "supp_nation": "sn"})
    return out.select("o_orderkey", F.col("cn_n_name").alias("customer_nation"), F.col("sn_n_name").alias("supplier_nation"))


@register("j4_orphan_orders", """
SELECT o.o_orderkey, o.o_custkey FROM orders o
LEFT JOIN (SELECT c_custkey FROM customer WHERE c_acctbal >= 0) c ON o.o_custkey = c.c_custkey
WHERE c.c_custkey IS NULL""", ["J4", "J7"])
def j4(t: Tables):
    good = t.customer.filter(F.col("c_acctbal") >= 0).select("c_custkey")
    return J.anti_join(t.orders.select("o_orderkey", "o_custkey"), good, "o_custkey", "c_custkey")


@register("j5_unmatched_distinct_keys", """
SELECT DISTINCT l_suppkey FROM lineitem WHERE l_suppkey NOT IN (SELECT s_suppkey FROM supplier WHERE s_acctbal > 0)""",
          ["J5"])
def j5(t: Tables):
    good = t.supplier.filter(F.col("s_acctbal") > 0).select("s_suppkey")
    return J.anti_join(t.lineitem.select("l_suppkey"), good, "l_suppkey", "s_suppkey", distinct_keys=True)


@register("j6_reconcile_keys", """
SELECT COALESCE(a.k, b.k) AS custkey,
       CASE WHEN a.k IS NOT NULL AND b.k IS NOT NULL THEN 'both' WHEN a.k IS NOT NULL THEN 'left_only' ELSE 'right_only' END AS side
FROM (SELECT DISTINCT o_custkey AS k FROM orders WHERE o_orderstatus = 'F') a
FULL OUTER JOIN (SELECT c_custkey AS k FROM customer WHERE c_mktsegment IN ('BUILDING', 'AUTOMOBILE', 'HOUSEHOLD')) b
ON a.k = b.k""", ["J6"])
def j6(t: Tables):
    a = t.orders.filter(F.col("o_orderstatus") == "F").select(F.col("o_custkey").alias("custkey"))
    b = t.customer.filter(F.col("c_mktsegment").isin("BUILDING", "AUTOMOBILE", "HOUSEHOLD")).select(
        F.col("c_custkey").alias("custkey"))
    return J.reconcile_keys(a, b, ["custkey"])


@register("j8_expand_region_to_nations", f"""
SELECT r.region_id, n.n_nationkey AS nation_id, r.total_balance, TRUE AS is_replicated
FROM (SELECT n_regionkey AS region_id, {r2('SUM(s_acctbal)')} AS total_balance
      FROM supplier JOIN nation ON s_nationkey = n_nationkey GROUP BY n_regionkey) r
JOIN (SELECT DISTINCT n_regionkey, n_nationkey FROM nation) n ON n.n_regionkey = r.region_id""", ["J8", "F11"])
def j8(t: Tables):
    from ..functions.common import round_half_up
    s = t.supplier.join(t.nation, F.col("s_nationkey") == F.col("n_nationkey"))
    reg = s.groupBy(F.col("n_regionkey").alias("region_id")).agg(round_half_up(F.sum("s_acctbal")).alias("total_balance"))
    bridge = t.nation.select(F.col("n_regionkey").alias("region_id"), F.col("n_nationkey").alias("nation_id"))
    return J.expand_to_members(reg, bridge, "region_id", ["nation_id"]).select(
        "region_id", "nation_id", "total_balance", "is_replicated")


BRAND_GROUPS = {f"Brand#{i}": f"group_{(i - 1) // 5 + 1}" for i in range(1, 26)}


@register("j10_brand_mapping", """
SELECT p_partkey, 'group_' || CAST((CAST(substring(p_brand, 7) AS INTEGER) - 1) // 5 + 1 AS VARCHAR) AS brand_group
FROM part""", ["J10"])
def j10(t: Tables):
    mapping = t.spark.createDataFrame(list(BRAND_GROUPS.items()), "key string, value string")
    return J.map_values(t.part.select("p_partkey", "p_brand"), "p_brand", mapping, output="brand_group").select(
        "p_partkey", "brand_group")


@register("j11_fill_from_second_source", """
SELECT u.user_id, COALESCE(a.v, b.v) AS first_value,
       CASE WHEN a.v IS NOT NULL THEN 'primary' WHEN b.v IS NOT NULL THEN 'secondary' END AS source
FROM (SELECT DISTINCT user_id FROM events) u
LEFT JOIN (SELECT user_id, MIN(value) AS v FROM events WHERE event_type = 'purchase' GROUP BY user_id) a ON u.user_id = a.user_id
LEFT JOIN (SELECT user_id, MIN(value) AS v FROM events WHERE event_type = 'view' GROUP BY user_id) b ON u.user_id = b.user_id""",
          ["J11"])
def j11(t: Tables):
    e = t.events.select("user_id", "event_type", "value")
    users = e.select("user_id").distinct()
    a = e.filter(F.col("event_type") == "purchase").groupBy("user_id").agg(F.min("value").alias("first_value"))
    b = e.filter(F.col("event_type") == "view").groupBy("user_id").agg(F.min("value").alias("first_value"))
    prim = users.join(a, "user_id", "left")
    return J.fill_from_source(prim, b, ["user_id"], ["first_value"]).select("user_id", "first_value", "source")


@register("j15_counts_per_region", """
SELECT r.r_regionkey, r.r_name,
  CAST((SELECT COUNT(*) FROM nation n WHERE n.n_regionkey = r.r_regionkey) AS BIGINT) AS n_nations,
  CAST((SELECT COUNT(*) FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey WHERE n.n_regionkey = r.r_regionkey) AS BIGINT) AS n_customers,
  CAST((SELECT COUNT(*) FROM supplier s JOIN nation n ON s.s_nationkey = n.n_nationkey WHERE n.n_regionkey = r.r_regionkey) AS BIGINT) AS n_suppliers
FROM region r""", ["J15", "A6", "A5"])
def j15(t: Tables):
    n = t.nation.select("n_nationkey", "n_regionkey")
    cust = t.customer.join(n, F.col("c_nationkey") == F.col("n_nationkey")).select("n_regionkey")
    supp = t.supplier.join(n, F.col("s_nationkey") == F.col("n_nationkey")).select("n_regionkey")
    return J.counts_per_parent(t.region.select("r_regionkey", "r_name"), "r_regionkey", {
        "n_nations": (n, "n_regionkey"), "n_customers": (cust, "n_regionkey"), "n_suppliers": (supp, "n_regionkey")})


@register("k1_dedupe_first_per_key", f"""
SELECT {', '.join(LINE_COLS)} FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {_ORDER_SQL}) AS rn FROM lineitem) z
WHERE rn = 1""", ["K1", "K4"])
def k1(t: Tables):
    return K.keep_first_per_key(t.lineitem, ["l_orderkey", "l_linenumber"], list(LINE_ORDER)).select(*LINE_COLS)


@register("k2_prefer_flagged", f"""
SELECT {', '.join(LINE_COLS)} FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY l_orderkey, l_linenumber
        ORDER BY CASE WHEN COALESCE(l_returnflag = 'R', FALSE) THEN 0 ELSE 1 END, {_ORDER_SQL}) AS rn FROM lineitem) z
WHERE rn = 1""", ["K2"])
def k2(t: Tables):
    return K.keep_flagged_per_key(t.lineitem, ["l_orderkey", "l_linenumber"], F.col("l_returnflag") == "R",
                                  list(LINE_ORDER)).select(*LINE_COLS)


@register("k3_latest_event_per_user", """
SELECT event_id, ts, user_id, event_type, value FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events) z WHERE rn = 1""",
          ["K3", "W11"])
def k3(t: Tables):
    e = t.events.select("event_id", "ts", "user_id", "event_type", "value")
    return K.latest_per_key(e, ["user_id"], "ts", "event_id")


@register("k4_dedupe_null_keys", """
SELECT event_id, k, event_type FROM (
  SELECT event_id, CASE WHEN user_id % 4 = 0 THEN NULL ELSE user_id END AS k, event_type,
         ROW_NUMBER() OVER (PARTITION BY CASE WHEN user_id % 4 = 0 THEN NULL ELSE user_id END, event_type
                            ORDER BY event_id) AS rn FROM events) z WHERE rn = 1""", ["K4"])
def k4(t: Tables):
    e = t.events.select("event_id", F.when(F.col("user_id") % 4 != 0, F.col("user_id")).alias("k"), "event_type")
    return K.keep_first_per_key(e, ["k", "event_type"], ["event_id"])


@register("k5_sequential_unique", f"""
WITH a AS (SELECT * FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {_ORDER_SQL}) rn
                          FROM lineitem) z WHERE rn = 1),
b AS (SELECT * FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY l_partkey, l_suppkey ORDER BY {_ORDER_SQL}) rn2
                     FROM a) z WHERE rn2 = 1)
SELECT {', '.join(LINE_COLS)} FROM b""", ["K5"])
def k5(t: Tables):
    return K.sequential_unique(t.lineitem, [["l_orderkey", "l_linenumber"], ["l_partkey", "l_suppkey"]],
                               list(LINE_ORDER)).select(*LINE_COLS)


@register("u1_union_balances", """
SELECT 'customer' AS party, c_custkey AS party_key, c_nationkey AS nation_key, c_acctbal AS balance, c_mktsegment AS segment FROM customer
UNION ALL
SELECT 'supplier', s_suppkey, s_nationkey, s_acctbal, NULL FROM supplier""", ["U1", "U2", "F11"])
def u1(t: Tables):
    c = t.customer.select(F.lit("customer").alias("party"), F.col("c_custkey").alias("party_key"),
                          F.col("c_nationkey").alias("nation_key"), F.col("c_acctbal").alias("balance"),
                          F.col("c_mktsegment").alias("segment"))
    s = t.supplier.select(F.lit("supplier").alias("party"), F.col("s_suppkey").alias("party_key"),
                          F.col("s_nationkey").alias("nation_key"), F.col("s_acctbal").alias("balance"))
    return K.union_aligned(c, s)


@register("u3_key_difference", """
SELECT DISTINCT c_nationkey AS nation_key, 'customers_only' AS kind FROM customer
WHERE c_nationkey NOT IN (SELECT s_nationkey FROM supplier WHERE s_acctbal > 5000)
UNION ALL
SELECT DISTINCT c_nationkey, 'both' FROM customer WHERE c_nationkey IN (SELECT s_nationkey FROM supplier WHERE s_acctbal > 5000)""",
          ["U3"])
def u3(t: Tables):
    c = t.customer.select(F.col("c_nationkey").alias("nation_key"))
    s = t.supplier.filter(F.col("s_acctbal") > 5000).select(F.col("s_nationkey").alias("nation_key"))
    diff = K.key_difference(c, s, ["nation_key"]).withColumn("kind", F.lit("customers_only"))
    both = K.key_intersection(c, s, ["nation_key"]).withColumn("kind", F.lit("both"))
    return diff.unionByName(both)


@register("u4_distinct_types", "SELECT DISTINCT p_type, p_size FROM part", ["U4"])
def u4(t: Tables):
    return K.dedupe_rows(t.part.select("p_type", "p_size"))


@register("w10_surrogate_key", """
SELECT ROW_NUMBER() OVER (ORDER BY o_orderdate, o_orderkey) AS id, o_orderkey FROM orders""", ["W10"])
def w10(t: Tables):
    return K.surrogate_key(t.orders.select("o_orderkey", "o_orderdate"), ["o_orderdate", "o_orderkey"]).select(
        "id", "o_orderkey")
