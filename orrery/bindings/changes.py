"""Mixed plan changes made from orders and events."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..plans.changes import PLAN_ENTITIES, replay
from ..tables import Tables
from . import standins as S
from .registry import register

_PLAN_OPS = "CASE o_orderkey % 5 WHEN 0 THEN 'delete' WHEN 3 THEN 'delete' WHEN 1 THEN 'insert' ELSE 'upsert' END"
_PREF_OPS = "CASE o_orderkey % 7 % 3 WHEN 0 THEN 'upsert' WHEN 1 THEN 'insert' ELSE 'delete' END"
_CATEGORY = "CASE o_orderkey % 8 WHEN 0 THEN 'PROMO' WHEN 1 THEN 'PROMO' WHEN 2 THEN 'LARGE' WHEN 3 THEN 'SMALL' ELSE 'STANDARD' END"

# Two changes of a plan and of its preferences, taking turns; spending goes on between them.
PLANS = "SELECT o_orderkey AS plan_id, o_totalprice AS amount FROM orders WHERE o_orderkey % 3 <> 0"
PLAN_CHANGES = f"SELECT o_orderkey * 4 AS seq, {_PLAN_OPS} AS op, CAST(FLOOR(o_orderkey / 2) AS BIGINT) AS plan_id, o_totalprice / 2 AS amount FROM orders"
PREF_CHANGES = (f"SELECT o_orderkey * 4 + 1 AS seq, {_PREF_OPS} AS op, CAST(FLOOR(o_orderkey / 2) AS BIGINT) AS plan_id, {_CATEGORY} AS category, "
                "CAST(o_orderkey % 9 AS BIGINT) AS quantity FROM orders")
LEDGER = "SELECT event_id AS entry_id, user_id AS plan_id, value AS amount FROM events WHERE event_id % 2 = 0"
LEDGER_CHANGES = "SELECT event_id * 4 + 2 AS seq, 'append' AS op, event_id AS entry_id, user_id AS plan_id, value AS amount FROM events WHERE event_id % 2 = 1"

_ORACLE = f"""
WITH plans AS ({PLANS}), pc AS ({PLAN_CHANGES}), prefs AS ({S.PREFS_SQL}), fc AS ({PREF_CHANGES}), ledger AS ({LEDGER}), lc AS ({LEDGER_CHANGES}),
gone AS (SELECT plan_id, MAX(seq) AS at FROM pc WHERE op = 'delete' GROUP BY plan_id),
plan_log AS (SELECT plan_id, amount, -1 AS seq, 'stored' AS op FROM plans UNION ALL SELECT plan_id, amount, seq, op FROM pc),
plan_live AS (SELECT l.* FROM plan_log l LEFT JOIN gone g USING (plan_id) WHERE l.seq > COALESCE(g.at, -2) AND l.op <> 'delete'),
plan_end AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY plan_id ORDER BY CASE WHEN op = 'upsert' THEN seq ELSE -1 END DESC, seq) AS k FROM plan_live),
pref_log AS (SELECT plan_id, category, quantity, -1 AS seq, 'stored' AS op FROM prefs UNION ALL SELECT plan_id, category, quantity, seq, op FROM fc),
pref_gone AS (SELECT plan_id, category, MAX(seq) AS at FROM pref_log WHERE op = 'delete' GROUP BY 1, 2),
pref_live AS (SELECT l.* FROM pref_log l LEFT JOIN gone g USING (plan_id) LEFT JOIN pref_gone o USING (plan_id, category)
              WHERE l.seq > COALESCE(g.at, -2) AND l.seq > COALESCE(o.at, -2) AND l.op <> 'delete'),
pref_end AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY plan_id, category ORDER BY CASE WHEN op = 'upsert' THEN seq ELSE -1 END DESC, seq) AS k FROM pref_live),
spent AS (SELECT *, -1 AS seq FROM ledger UNION ALL SELECT entry_id, plan_id, amount, seq FROM lc)
SELECT 'plans' AS entity, plan_id, CAST(NULL AS VARCHAR) AS item, amount FROM plan_end WHERE k = 1
UNION ALL SELECT 'prefs', plan_id, category, CAST(quantity AS DOUBLE) FROM pref_end WHERE k = 1
UNION ALL SELECT 'ledger', s.plan_id, CAST(s.entry_id AS VARCHAR), s.amount FROM spent s LEFT JOIN gone g USING (plan_id) WHERE s.seq > COALESCE(g.at, -2)
"""


@register("p14_p17_mixed_changes", _ORACLE, ["P14", "P15", "P16", "P17"])
def mixed_changes(t: Tables):
    for name in ("orders", "events"):
        getattr(t, name).createOrReplaceTempView(name)
    sql = t.spark.sql
    tables = {"plans": sql(PLANS), "prefs": S.prefs(t).select("plan_id", "category", "quantity"), "ledger": sql(LEDGER)}
    changes = {"plans": sql(PLAN_CHANGES), "prefs": sql(PREF_CHANGES), "ledger": sql(LEDGER_CHANGES)}
    now = replay(tables, changes, PLAN_ENTITIES)
    return (now["plans"].select(F.lit("plans").alias("entity"), "plan_id", F.lit(None).cast("string").alias("item"), "amount")
            .unionByName(now["prefs"].select(F.lit("prefs").alias("entity"), "plan_id", F.col("category").alias("item"), F.col("quantity").cast("double").alias("amount")))
            .unionByName(now["ledger"].select(F.lit("ledger").alias("entity"), "plan_id", F.col("entry_id").cast("string").alias("item"), "amount")))
