"""Data-quality operators Q1-Q16 on the driver tables (each report is
computed over the whole table; gaps are created inside the query)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import quality as Q
from ..tables import Tables
from . import standins as S
from .registry import register
from .sqlutil import r2


@register("q1_duplicate_line_keys", """
SELECT l_orderkey, l_linenumber, COUNT(*) AS n FROM lineitem GROUP BY 1, 2 HAVING COUNT(*) > 1""", ["Q1"])
def q1(t: Tables):
    return Q.duplicate_keys(t.lineitem, ["l_orderkey", "l_linenumber"])


@register("q2_orphan_suppliers", """
SELECT s.s_suppkey, s.s_nationkey FROM supplier s
LEFT JOIN (SELECT n_nationkey FROM nation WHERE n_regionkey <> 2) n ON s.s_nationkey = n.n_nationkey
WHERE n.n_nationkey IS NULL""", ["Q2", "J4"])
def q2(t: Tables):
    parent = t.nation.filter(F.col("n_regionkey") != 2)
    return Q.orphans(t.supplier.select("s_suppkey", "s_nationkey"), parent, "s_nationkey", "n_nationkey")


@register("q3_orphans_ignoring_null", """
SELECT c.c_custkey, c.k FROM (SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE c_nationkey END AS k FROM customer) c
LEFT JOIN (SELECT n_nationkey FROM nation WHERE n_regionkey <> 1) n ON c.k = n.n_nationkey
WHERE c.k IS NOT NULL AND n.n_nationkey IS NULL""", ["Q3"])
def q3(t: Tables):
    c = t.customer.select("c_custkey", F.when(F.col("c_custkey") % 3 != 0, F.col("c_nationkey")).alias("k"))
    return Q.orphans(c, t.nation.filter(F.col("n_regionkey") != 1), "k", "n_nationkey", ignore_null=True)


@register("q4_null_coordinates", f"""
SELECT s_suppkey FROM (SELECT s_suppkey, CASE WHEN s_suppkey % 9 = 0 THEN NULL ELSE lat END AS lat, lon
                       FROM ({S.SUPPLIER_GEO_SQL}) g) z WHERE lat IS NULL OR lon IS NULL""", ["Q4"])
def q4(t: Tables):
    g = S.supplier_geo(t).select("s_suppkey", F.when(F.col("s_suppkey") % 9 != 0, F.col("lat")).alias("lat"), "lon")
    return Q.null_coordinates(g).select("s_suppkey")


@register("q5_out_of_range", """
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_discount FROM lineitem
WHERE COALESCE(NOT (l_quantity BETWEEN 2 AND 49), FALSE) OR COALESCE(NOT (l_discount BETWEEN 0.01 AND 0.09), FALSE)""",
          ["Q5", "F3"])
def q5(t: Tables):
    li = t.lineitem.select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_discount")
    return Q.out_of_range(li, {"l_quantity": (2, 49), "l_discount": (0.01, 0.09)})


@register("q6_customers_without_recent_orders", """
SELECT c.c_custkey, c.c_name, c.c_nationkey FROM customer c
WHERE NOT EXISTS (SELECT 1 FROM orders o WHERE o.o_custkey = c.c_custkey AND o.o_orderdate >= TIMESTAMP '2001-01-01')""",
          ["Q6"])
def q6(t: Tables):
    recent = t.orders.filter(F.col("o_orderdate") >= F.lit("2001-01-01").cast("timestamp_ntz"))
    return Q.missing_coverage(t.customer, recent, "c_custkey", "o_custkey", context=["c_name", "c_nationkey"])


@register("q7_unmatched_report", """
SELECT l_suppkey, COUNT(*) AS frequency FROM lineitem
WHERE l_suppkey NOT IN (SELECT s_suppkey FROM supplier WHERE s_acctbal > 1000) GROUP BY l_suppkey""", ["Q7", "IO12"])
def q7(t: Tables):
    ref = t.supplier.filter(F.col("s_acctbal") > 1000)
    return Q.unmatched_report(t.lineitem.select("l_suppkey"), ref, "l_suppkey", "s_suppkey")


@register("q8_key_summary", """
SELECT COUNT(*) AS n_rows, COUNT(*) FILTER (WHERE k IS NULL) AS n_null,
       COUNT(*) FILTER (WHERE COALESCE(trim(CAST(k AS VARCHAR)) = '', FALSE)) AS n_blank, COUNT(DISTINCT k) AS n_distinct,
       (SELECT COUNT(*) FROM (SELECT l_orderkey AS k2 FROM lineitem GROUP BY 1 HAVING COUNT(*) > 1) d) AS duplicated_values
FROM (SELECT l_orderkey AS k FROM lineitem) z""", ["Q8"])
def q8(t: Tables):
    return Q.key_summary(t.lineitem.select("l_orderkey"), "l_orderkey")


def _profile_sql(table: str, columns: dict[str, str]) -> str:
    """One row a column; decimals by the shortest text of a number."""
    rows = []
    for i, (c, kind) in enumerate(columns.items(), 1):
        decimals = f"MAX(CASE WHEN {c} IS NULL THEN NULL ELSE length(rtrim(split_part(CAST({c} AS VARCHAR), '.', 2), '0')) END)" if kind == "numeric" else "NULL"
        rows.append(f"SELECT {i} AS position, '{c}' AS column_name, '{kind}' AS kind, COUNT(*) FILTER (WHERE {c} IS NULL) AS n_null, "
                    f"{r2(f'COUNT(*) FILTER (WHERE {c} IS NULL) * 100.0 / COUNT(*)')} AS null_pct, CAST(MAX(length(CAST({c} AS VARCHAR))) AS INTEGER) AS max_length, "
                    f"CAST(MIN({c}) AS VARCHAR) AS min_value, CAST(MAX({c}) AS VARCHAR) AS max_value, CAST({decimals} AS INTEGER) AS max_decimals FROM {table}")
    return " UNION ALL ".join(rows)


@register("q9_column_profile", _profile_sql("supplier", {"s_suppkey": "numeric", "s_name": "text", "s_nationkey": "numeric", "s_acctbal": "numeric"}),
          ["Q9", "Q12"])
def q9(t: Tables):
    return Q.column_profile(t.supplier)


@register("q9_document_profile", _profile_sql("documents", {"doc_id": "numeric", "text": "text", "lang": "text", "source": "text", "n_chars": "numeric"}),
          ["Q9", "Q12"])
def q9_documents(t: Tables):
    return Q.column_profile(t.documents)


@register("q9_null_profile", f"""
SELECT 'price' AS column_name, COUNT(*) FILTER (WHERE price IS NULL) AS n_null,
       {r2('COUNT(*) FILTER (WHERE price IS NULL) * 100.0 / COUNT(*)')} AS null_pct,
       CAST(MIN(price) AS VARCHAR) AS min_value, CAST(MAX(price) AS VARCHAR) AS max_value
FROM (SELECT CASE WHEN l_orderkey % 7 = 0 THEN NULL ELSE l_extendedprice END AS price FROM lineitem) z""", ["Q12", "Q9"])
def q9n(t: Tables):
    li = t.lineitem.select(F.when(F.col("l_orderkey") % 7 != 0, F.col("l_extendedprice")).alias("price"))
    return Q.column_profile(li).select("column_name", "n_null", "null_pct", "min_value", "max_value")


@register("q10_functional_dependency", """
SELECT s_name, COUNT(DISTINCT s_nationkey) AS n_values FROM (
  SELECT s_name, s_nationkey FROM supplier UNION ALL
  SELECT s_name, (s_nationkey + 1) % 25 FROM supplier WHERE s_suppkey % 10 = 0) z
GROUP BY s_name HAVING COUNT(DISTINCT s_nationkey) > 1""", ["Q10", "Q11"])
def q10(t: Tables):
    s = t.supplier.select("s_suppkey", "s_name", "s_nationkey")
    shifted = s.filter(F.col("s_suppkey") % 10 == 0).select("s_suppkey", "s_name",
                                                           ((F.col("s_nationkey") + 1) % 25).alias("s_nationkey"))
    return Q.functional_dependency_violations(s.unionByName(shifted), ["s_name"], "s_nationkey")


@register("q13_iqr_summary", f"""
WITH b AS (SELECT quantile_cont(l_extendedprice, 0.25) AS q1, quantile_cont(l_extendedprice, 0.75) AS q3 FROM lineitem)
SELECT {r2('q1')} AS q1, {r2('q3')} AS q3, {r2('q1 - 1.5 * (q3 - q1)')} AS lower_fence, {r2('q3 + 1.5 * (q3 - q1)')} AS upper_fence,
       COUNT(*) FILTER (WHERE l_extendedprice < q1 - 1.5 * (q3 - q1) OR l_extendedprice > q3 + 1.5 * (q3 - q1)) AS n_outliers,
       {r2('AVG(CASE WHEN l_extendedprice < q1 - 1.5 * (q3 - q1) OR l_extendedprice > q3 + 1.5 * (q3 - q1) THEN 1 ELSE 0 END) * 100')} AS outlier_pct
FROM lineitem, b GROUP BY q1, q3""", ["Q13"])
def q13(t: Tables):
    return Q.iqr_summary(t.lineitem.select("l_extendedprice"), "l_extendedprice")


@register("q13_iqr_flags", f"""
WITH b AS (SELECT quantile_cont(l_extendedprice, 0.25) AS a1, quantile_cont(l_extendedprice, 0.75) AS a3,
                  quantile_cont(l_quantity, 0.25) AS b1, quantile_cont(l_quantity, 0.75) AS b3 FROM lineitem),
f AS (SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_shipdate, l_returnflag,
        COALESCE(l_extendedprice < a1 - 1.5 * (a3 - a1) OR l_extendedprice > a3 + 1.5 * (a3 - a1), FALSE) AS l_extendedprice_outlier,
        COALESCE(l_quantity < b1 - 1.5 * (b3 - b1) OR l_quantity > b3 + 1.5 * (b3 - b1), FALSE) AS l_quantity_outlier
      FROM lineitem, b)
SELECT l_returnflag, COUNT(*) FILTER (WHERE l_extendedprice_outlier OR l_quantity_outlier) AS n_outliers,
       {r2('AVG(CASE WHEN l_extendedprice_outlier OR l_quantity_outlier THEN 1 ELSE 0 END) * 100')} AS outlier_share_pct
FROM f GROUP BY l_returnflag""", ["Q13", "A21"])
def q13f(t: Tables):
    from ..functions.common import round_half_up
    li = t.lineitem.select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_shipdate", "l_returnflag",
                           "l_extendedprice", "l_quantity")
    f = Q.iqr_flags(li, ["l_extendedprice", "l_quantity"])
    return f.groupBy("l_returnflag").agg(
        F.count_if("is_outlier").alias("n_outliers"),
        round_half_up(F.avg(F.col("is_outlier").cast("int")) * 100).alias("outlier_share_pct"))


@register("q15_repeated_names", """
SELECT c.c_custkey, c.c_name, r.n FROM (SELECT c_custkey, CASE WHEN c_custkey % 50 = 1 THEN 'Customer#000000000 ' ELSE c_name END AS c_name
                                    FROM customer) c
JOIN (SELECT lower(trim(nm)) AS k, COUNT(*) AS n FROM (SELECT CASE WHEN c_custkey % 50 = 1 THEN 'Customer#000000000 ' ELSE c_name END AS nm FROM customer) z
      GROUP BY 1 HAVING COUNT(*) > 1) r ON lower(trim(c.c_name)) = r.k""", ["Q15"])
def q15(t: Tables):
    c = t.customer.select("c_custkey", F.when(F.col("c_custkey") % 50 == 1, F.lit("Customer#000000000 "))
                          .otherwise(F.col("c_name")).alias("c_name"))
    return Q.repeated_names(c, "c_name").select("c_custkey", "c_name", "n")


_ORDER_RULES_SQL = {
    "total_non_negative": "o_totalprice >= 0",
    "date_present": "o_orderdate IS NOT NULL",
    "priority_known": "o_orderpriority IN ('1-URGENT', '2-HIGH', '3-MEDIUM')",
    "status_open_or_final": "o_orderstatus IN ('O', 'F')",
}


def _order_rules():
    return {
        "total_non_negative": F.col("o_totalprice") >= 0,
        "date_present": F.col("o_orderdate").isNotNull(),
        "priority_known": F.col("o_orderpriority").isin("1-URGENT", "2-HIGH", "3-MEDIUM"),
        "status_open_or_final": F.col("o_orderstatus").isin("O", "F"),
    }


@register("q16_rule_violations", " UNION ALL ".join(
    f"SELECT o_orderkey, '{n}' AS rule FROM orders WHERE NOT COALESCE({c}, FALSE)" for n, c in _ORDER_RULES_SQL.items()),
          ["Q16", "Q14"])
def q16(t: Tables):
    return Q.rule_violations(t.orders, _order_rules(), ["o_orderkey"])


@register("q16_rule_summary", " UNION ALL ".join(
    f"SELECT '{n}' AS rule, COUNT(*) FILTER (WHERE NOT COALESCE({c}, FALSE)) AS n_violations FROM orders"
    for n, c in _ORDER_RULES_SQL.items()), ["Q16"])
def q16s(t: Tables):
    return Q.rule_summary(t.orders, _order_rules())
