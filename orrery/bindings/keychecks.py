"""Schema-wide key checks and checks while writing, on the driver tables."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..operators.keychecks import ForeignKey, foreign_key_report, unique_key_report, unique_key_summary
from ..operators.quality import QualityError
from ..sources import io as IO
from ..sources import publish
from ..tables import Tables
from .registry import register

# Every reference between the driver tables. Users of events are no customers
# and labels may name documents that are not there: these report rows.
SCHEMA_KEYS = (
    ForeignKey("nation", ("n_regionkey",), "region", ("r_regionkey",)),
    ForeignKey("customer", ("c_nationkey",), "nation", ("n_nationkey",)),
    ForeignKey("supplier", ("s_nationkey",), "nation", ("n_nationkey",)),
    ForeignKey("orders", ("o_custkey",), "customer", ("c_custkey",)),
    ForeignKey("lineitem", ("l_orderkey",), "orders", ("o_orderkey",)),
    ForeignKey("lineitem", ("l_partkey",), "part", ("p_partkey",)),
    ForeignKey("lineitem", ("l_suppkey",), "supplier", ("s_suppkey",)),
    ForeignKey("lineitem", ("l_suppkey",), "customer", ("c_custkey",), name="supplier as customer"),
    ForeignKey("events", ("user_id",), "customer", ("c_custkey",)),
    ForeignKey("events", ("event_id",), "orders", ("o_orderkey",), optional=True),
    ForeignKey("labels", ("doc_id",), "documents", ("doc_id",)),
    ForeignKey("customer", ("c_custkey", "c_nationkey"), "supplier", ("s_suppkey", "s_nationkey"), name="customer is supplier"),
)


def _key_sql(k: ForeignKey) -> str:
    key = " || '|' || ".join(f"COALESCE(CAST(c.{c} AS VARCHAR), 'NULL')" for c in k.columns)
    on = " AND ".join(f"p.{b} = c.{a}" for a, b in zip(k.columns, k.target))
    nulls = "".join(f" AND c.{c} IS NOT NULL" for c in k.columns) if k.optional else ""
    return (f"SELECT '{k.child}' AS child, '{k.constraint}' AS \"constraint\", {key} AS key, COUNT(*) AS n FROM {k.child} c "
            f"WHERE NOT EXISTS (SELECT 1 FROM {k.parent} p WHERE {on}){nulls} GROUP BY {key}")


@register("q2_schema_foreign_keys", " UNION ALL ".join(map(_key_sql, SCHEMA_KEYS)), ["Q2", "Q3", "J4"])
def schema_foreign_keys(t: Tables):
    return foreign_key_report({n: getattr(t, n) for k in SCHEMA_KEYS for n in (k.child, k.parent)}, SCHEMA_KEYS)


LINE_KEYS = {"line": ("l_orderkey", "l_linenumber"), "part of supplier": ("l_partkey", "l_suppkey"), "ship day": ("l_shipdate",),
             "order and part": ("l_partkey", "l_orderkey")}


def _text(column: str) -> str:
    if column == "l_shipdate":
        return "strftime(l_shipdate, '%Y-%m-%d %H:%M:%S')"
    return f"CAST({column} AS VARCHAR)"


@register("q1_unique_keys", " UNION ALL ".join(
    f"SELECT '{n}' AS \"constraint\", {' || CHR(124) || '.join(map(_text, c))} AS key, COUNT(*) AS n FROM lineitem GROUP BY {', '.join(c)} HAVING COUNT(*) > 1"
    for n, c in LINE_KEYS.items()), ["Q1"])
def unique_keys(t: Tables):
    return unique_key_report(t.lineitem, LINE_KEYS)


_EVENTS_SQL = "SELECT event_id, CASE WHEN event_id % 5 = 0 THEN NULL ELSE user_id END AS user_id, CASE WHEN event_id % 11 = 0 THEN ' ' ELSE event_type END AS event_type FROM events"
EVENT_KEYS = {"event": ("event_id",), "user": ("user_id",), "user and type": ("user_id", "event_type")}


@register("q8_unique_key_summary", f"WITH e AS ({_EVENTS_SQL}) " + " UNION ALL ".join(
    f"""SELECT '{n}' AS "constraint", CAST(SUM(k) AS BIGINT) AS n_rows, CAST(COALESCE(SUM(k) FILTER (WHERE NOT whole), 0) AS BIGINT) AS n_null,
    CAST(COALESCE(SUM(k) FILTER (WHERE blank), 0) AS BIGINT) AS n_blank, COUNT(*) FILTER (WHERE whole) AS n_distinct,
    COUNT(*) FILTER (WHERE whole AND k > 1) AS n_duplicated
    FROM (SELECT COUNT(*) AS k, {' AND '.join(f'{x} IS NOT NULL' for x in c)} AS whole,
          {' OR '.join(f"COALESCE(trim(CAST({x} AS VARCHAR)) = '', FALSE)" for x in c)} AS blank FROM e GROUP BY {', '.join(c)}) g"""
    for n, c in EVENT_KEYS.items()), ["Q8", "Q1"])
def unique_summary(t: Tables):
    e = t.events.select("event_id", F.when(F.col("event_id") % 5 != 0, F.col("user_id")).alias("user_id"),
                        F.when(F.col("event_id") % 11 == 0, F.lit(" ")).otherwise(F.col("event_type")).alias("event_type"))
    return unique_key_summary(e, EVENT_KEYS)


@register("io10_published_load", """
SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders WHERE o_orderstatus = 'F'""", ["IO10", "IO8"])
def published_load(t: Tables):
    """Two loads of one catalog table; a third breaks a rule and changes nothing."""
    table, location = f"orders_{uuid.uuid4().hex}", IO.scratch_path(t.spark, "io10")
    o = t.orders.select("o_orderkey", "o_orderstatus", "o_totalprice")
    publish.publish_table(o, table, location)
    publish.publish_table(o.filter("o_orderstatus = 'F'"), table, location, rules={"key": F.col("o_orderkey").isNotNull()})
    try:
        publish.publish_table(o, table, location, rules={"finished": F.col("o_orderstatus") == "F"})
    except QualityError:
        pass
    out = t.spark.read.parquet(publish.current_location(t.spark, table))
    t.spark.sql(f"DROP TABLE {table}")
    return out


@register("q14_checks_while_writing", """
SELECT COUNT(*) AS n_rows, COUNT(*) FILTER (WHERE NOT l_discount BETWEEN 0 AND 0.05) AS high_discount,
       COUNT(*) FILTER (WHERE NOT l_quantity > 0) AS quantity, COUNT(*) FILTER (WHERE l_orderkey % 7 = 0) AS price_known,
       CAST(MAX(l_shipdate) AS TIMESTAMP) AS last_ship FROM lineitem""", ["Q14", "IO12", "Q16"])
def checks_while_writing(t: Tables):
    """The figures come from the one job that writes the rows."""
    li = t.lineitem.withColumn("price", F.when(F.col("l_orderkey") % 7 != 0, F.col("l_extendedprice")))
    rows, seen = publish.observed(li, {"high_discount": F.col("l_discount").between(0, 0.05), "quantity": F.col("l_quantity") > 0,
                                       "price_known": F.col("price").isNotNull()}, {"last_ship": F.max("l_shipdate")})
    rows.write.parquet(IO.scratch_path(t.spark, "q14"))
    return t.spark.createDataFrame([tuple(seen.get[c] for c in ("n_rows", "high_discount", "quantity", "price_known", "last_ship"))],
                                   "n_rows long, high_discount long, quantity long, price_known long, last_ship timestamp_ntz")
