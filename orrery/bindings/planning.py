"""Trip planning P1-P19 bound to orders (plans), lineitem (stops and
preferences) and events (spend ledger)."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import functions as F

from ..plans import colocated
from ..plans import planning as P
from ..plans import recipes as M
from ..sources.io import scratch_path
from ..tables import Tables
from . import standins as S
from .recipes import M1_SQL
from .registry import register
from .sqlutil import r2

AS_OF = dt.date(1998, 1, 1)


def _summary(t: Tables):
    return P.plan_summary(S.plans(t), S.stops(t), S.prefs(t), S.countries(t), S.provinces(t))


def _activity_rec(t: Tables):
    return M.activities_by_province(S.activity_fact(t), S.provinces(t))


def _lodging_rec(t: Tables):
    return M.price_by_province(S.lodging_fact(t), S.provinces(t))


M2_SQL = f"""
WITH f AS ({S.ACTIVITY_FACT_SQL}), p AS ({S.PROVINCES_SQL})
SELECT f.country_id, f.province_id, p.province_name, f.category, COUNT(*) AS n_rows,
       {r2('AVG(f.entry_price)')} AS avg_entry_price, {r2('AVG(f.total_spend)')} AS avg_spend
FROM f JOIN p ON f.province_id = p.province_id
GROUP BY f.country_id, f.province_id, p.province_name, f.category
"""

SUMMARY_SQL = f"""
WITH plans AS ({S.PLANS_SQL}), stops AS ({S.STOPS_SQL}), prefs AS ({S.PREFS_SQL}),
c AS ({S.COUNTRIES_SQL}), p AS ({S.PROVINCES_SQL}),
main AS (SELECT s.plan_id, s.province_id AS dest_province_id, p.province_name AS dest_province
         FROM stops s JOIN p ON s.province_id = p.province_id WHERE s.stop_order = 1),
cats AS (SELECT plan_id, STRING_AGG(category || ' (' || CAST(quantity AS VARCHAR) || ')', ', ' ORDER BY category)
                AS activity_categories FROM prefs GROUP BY plan_id)
SELECT pl.plan_id, pl.user_id, pl.origin_country_id, co.country_name AS origin_country,
       pl.dest_country_id, cd.country_name AS dest_country, m.dest_province_id, m.dest_province,
       pl.start_date, pl.end_date, CAST(pl.end_date - pl.start_date + 1 AS INTEGER) AS trip_days,
       CAST(pl.end_date - pl.start_date AS INTEGER) AS trip_nights, pl.budget, pl.trip_type, pl.lodging_category,
       COALESCE(ct.activity_categories, '') AS activity_categories, pl.created_at
FROM plans pl JOIN c co ON pl.origin_country_id = co.country_id JOIN c cd ON pl.dest_country_id = cd.country_id
LEFT JOIN main m ON pl.plan_id = m.plan_id LEFT JOIN cats ct ON pl.plan_id = ct.plan_id
"""

NIGHTS_SQL = """
SELECT plan_id, CAST(COUNT(*) AS INTEGER) AS nights_total,
       CAST(COUNT(*) FILTER (WHERE dayofweek(night) IN (5, 6)) AS INTEGER) AS nights_weekend,
       CAST(COUNT(*) FILTER (WHERE dayofweek(night) NOT IN (5, 6)) AS INTEGER) AS nights_weekday
FROM (SELECT s.plan_id, UNNEST(generate_series(CAST(s.start_date AS TIMESTAMP),
             CAST(s.end_date AS TIMESTAMP) - INTERVAL 1 DAY, INTERVAL 1 DAY)) AS night FROM summary s) x
GROUP BY plan_id
"""

LODGING_COST_SQL = f"""
SELECT s.plan_id, s.trip_nights, n.nights_weekday, n.nights_weekend, s.lodging_category,
       a.avg_weekday AS night_price_weekday, a.avg_weekend AS night_price_weekend,
       {r2('COALESCE(a.avg_weekday, 0) * COALESCE(n.nights_weekday, 0) + COALESCE(a.avg_weekend, 0) * COALESCE(n.nights_weekend, 0)')} AS lodging_cost
FROM summary s LEFT JOIN nights n ON s.plan_id = n.plan_id
LEFT JOIN lodging_rec a ON a.country_id = s.dest_country_id AND a.province_id = s.dest_province_id
                       AND a.category = s.lodging_category
"""

FOOD_COST_SQL = f"""
SELECT s.plan_id, s.trip_days, b.food_reference,
       {r2('COALESCE(b.food_reference, 0) * 0.12')} AS food_daily,
       {r2('COALESCE(b.food_reference, 0) * 0.12 * s.trip_days')} AS food_cost
FROM summary s LEFT JOIN (
  SELECT s2.plan_id, {r2('AVG(r.avg_entry_price)')} AS food_reference
  FROM summary s2 JOIN activity_rec r ON r.country_id = s2.dest_country_id AND r.province_id = s2.dest_province_id
  WHERE lower(trim(r.category)) = lower('{S.FOOD_CATEGORY}') GROUP BY s2.plan_id) b ON s.plan_id = b.plan_id
"""

GROUP_COSTS_SQL = f"""
SELECT plan_id,
  {r2("SUM(CASE WHEN cost_group = 'actividades' THEN category_price * quantity END)")} AS activities_cost,
  {r2("SUM(CASE WHEN cost_group = 'servicios' THEN category_price * quantity END)")} AS services_cost,
  {r2("SUM(CASE WHEN cost_group = 'otros' THEN category_price * quantity END)")} AS other_cost
FROM (
  SELECT s.plan_id, r.cost_group, pr.category, pr.quantity, {r2('AVG(r.avg_entry_price)')} AS category_price
  FROM summary s JOIN prefs pr ON pr.plan_id = s.plan_id
  JOIN (SELECT *, {S.cost_group_sql('category')} AS cost_group FROM activity_rec) r
    ON r.country_id = s.dest_country_id AND r.province_id = s.dest_province_id AND r.category = pr.category
  WHERE r.cost_group IN ('actividades', 'servicios', 'otros')
  GROUP BY 1, 2, 3, 4) d
GROUP BY plan_id
"""


def _ctes(*extra):
    base = [("summary", SUMMARY_SQL), ("prefs", S.PREFS_SQL), ("lodging_rec", M1_SQL), ("activity_rec", M2_SQL),
            ("nights", NIGHTS_SQL)]
    return S.with_ctes(*base, *extra)


ESTIMATE_SQL = f"""
SELECT s.plan_id, s.trip_days, s.trip_nights,
  COALESCE(l.lodging_cost, 0) AS lodging_cost, COALESCE(f.food_cost, 0) AS food_cost,
  COALESCE(g.activities_cost, 0) AS activities_cost, COALESCE(g.services_cost, 0) AS services_cost,
  COALESCE(g.other_cost, 0) AS other_cost,
  {r2('(COALESCE(l.lodging_cost, 0) + COALESCE(f.food_cost, 0) + COALESCE(g.activities_cost, 0) + COALESCE(g.services_cost, 0)) * 0.08')} AS transport_cost
FROM summary s LEFT JOIN lodging_cost l ON s.plan_id = l.plan_id LEFT JOIN food_cost f ON s.plan_id = f.plan_id
LEFT JOIN group_costs g ON s.plan_id = g.plan_id
"""
ESTIMATE_FULL_SQL = f"""
SELECT *, {r2('lodging_cost + food_cost + activities_cost + services_cost + other_cost + transport_cost')} AS total_cost
FROM ({ESTIMATE_SQL}) e
"""
COST_CTES = [("lodging_cost", LODGING_COST_SQL), ("food_cost", FOOD_COST_SQL), ("group_costs", GROUP_COSTS_SQL),
             ("estimate", ESTIMATE_FULL_SQL)]


@register("m2_activities_by_province", M2_SQL, ["M2", "J2", "A9"])
def activities_by_province(t: Tables):
    return _activity_rec(t)


@register("m3_activity_cost_groups", f"SELECT *, {S.cost_group_sql('category')} AS cost_group FROM ({M2_SQL}) r",
          ["M3", "F7"])
def activity_cost_groups(t: Tables):
    return M.with_cost_group(_activity_rec(t), S.COST_GROUPS)


@register("p1_plan_summary", SUMMARY_SQL, ["P1", "J3", "J1", "A13", "D-1"])
def plan_summary(t: Tables):
    return _summary(t)


@register("p2_nights_by_day_type", _ctes() + " SELECT * FROM nights", ["P2", "D-2", "A8", "J13"])
def nights(t: Tables):
    return P.nights_by_day_type(_summary(t))


@register("p3_lodging_cost", _ctes() + LODGING_COST_SQL, ["P3", "J12"])
def lodging_cost(t: Tables):
    s = _summary(t)
    return P.lodging_cost(s, _lodging_rec(t))


@register("p4_food_cost", _ctes() + FOOD_COST_SQL, ["P4"])
def food_cost(t: Tables):
    return P.food_cost(_summary(t), _activity_rec(t), S.FOOD_CATEGORY)


@register("p5_group_costs", _ctes() + GROUP_COSTS_SQL, ["P5", "R1"])
def group_costs(t: Tables):
    return P.group_costs(_summary(t), S.prefs(t), _activity_rec(t), S.COST_GROUPS)


@register("p6_transport_cost", _ctes(*COST_CTES) + " SELECT plan_id, transport_cost FROM estimate", ["P6"])
def transport_cost(t: Tables):
    return estimate(t).select("plan_id", "transport_cost")


@register("p7_cost_estimate", _ctes(*COST_CTES) + " SELECT * FROM estimate", ["P7", "J12"])
def estimate(t: Tables, *carry: str):
    return P.estimate_all(S.plans(t), S.stops(t), S.prefs(t), S.countries(t), S.provinces(t),
                          _lodging_rec(t), _activity_rec(t), S.FOOD_CATEGORY, S.COST_GROUPS, carry=carry)


@register("p7_colocated_estimate", _ctes(*COST_CTES) + " SELECT * FROM estimate", ["P3", "P4", "P5", "P6", "P7", "J12"])
def colocated_estimate(t: Tables):
    """The cost chain over tables bucketed by plan."""
    prefix = f"plans_{uuid.uuid4().hex}"
    core = P.plan_core(S.plans(t), S.stops(t), S.countries(t), S.provinces(t))
    colocated.store_plan_tables(core, S.prefs(t), _lodging_rec(t), _activity_rec(t), prefix, scratch_path(t.spark, "plans"), buckets=8)
    return colocated.stored_estimate(t.spark, prefix, S.FOOD_CATEGORY, S.COST_GROUPS)


PAGE_SQL = f"""
SELECT plan_id, budget, lodging_cost, activities_cost, other_cost, CAST(0.0 AS DOUBLE) AS transport_cost,
  {r2('lodging_cost + activities_cost + other_cost')} AS page_total,
  CASE WHEN trip_days > 0 THEN {r2('(lodging_cost + activities_cost + other_cost) / trip_days')} ELSE 0.0 END AS cost_per_day,
  {r2('budget - (lodging_cost + activities_cost + other_cost)')} AS difference,
  days_left, months_left, {r2('(lodging_cost + activities_cost + other_cost) / months_left')} AS monthly_saving
FROM (
  SELECT s.plan_id, s.budget, s.trip_days, COALESCE(e.lodging_cost, 0.0) AS lodging_cost,
         COALESCE(e.activities_cost, 0.0) AS activities_cost,
         {r2('(COALESCE(e.lodging_cost, 0.0) + COALESCE(e.activities_cost, 0.0)) * 0.10')} AS other_cost,
         CAST(GREATEST(s.start_date - DATE '{AS_OF}', 0) AS INTEGER) AS days_left,
         CAST(GREATEST(CAST(ROUND_EVEN(CAST(GREATEST(s.start_date - DATE '{AS_OF}', 0) AS DOUBLE) / 30.0, 0) AS INTEGER), 1) AS INTEGER) AS months_left
  FROM summary s LEFT JOIN estimate e ON s.plan_id = e.plan_id) x
"""


def _page(t: Tables):
    return P.budget_page(estimate(t, "budget", "start_date"), F.lit(AS_OF))


@register("p8_budget_page", _ctes(*COST_CTES) + PAGE_SQL, ["P8", "D-3", "P10"])
def budget_page(t: Tables):
    return _page(t)


@register("p8_saving_schedule", _ctes(*COST_CTES, ("page", PAGE_SQL)) +
          " SELECT plan_id, CAST(UNNEST(generate_series(1, months_left)) AS INTEGER) AS month_no, monthly_saving FROM page",
          ["P8", "J13"])
def saving_schedule(t: Tables):
    return P.saving_schedule(_page(t))


SPEND_SQL = f"SELECT plan_id, {r2('SUM(amount)')} AS spent_total FROM ({S.LEDGER_SQL}) g GROUP BY plan_id"


@register("p9_approved_budget", _ctes(*COST_CTES, ("spend", SPEND_SQL)) + f"""
SELECT plan_id, {r2('approved')} AS approved_budget, spent AS spent_total, {r2('approved - spent')} AS remaining,
  executed AS executed_pct,
  CASE WHEN executed < 80 THEN 'within' WHEN executed <= 100 THEN 'near_limit' ELSE 'exceeded' END AS status
FROM (SELECT plan_id, approved, spent,
        CASE WHEN approved > 0 THEN {r2('spent / approved * 100')} ELSE 0.0 END AS executed
      FROM (SELECT e.plan_id, e.lodging_cost + e.activities_cost + e.transport_cost
                   + {r2('(e.lodging_cost + e.activities_cost) * 0.10')} AS approved,
                   COALESCE(sp.spent_total, 0.0) AS spent
            FROM estimate e LEFT JOIN spend sp ON e.plan_id = sp.plan_id) a) b
""", ["P9", "A25", "J1"])
def approved_budget(t: Tables):
    from ..operators.aggregates import totals_per_key
    spend = totals_per_key(S.ledger(t), ["plan_id"], "amount", total_col="spent_total")
    return P.approved_budget(estimate(t), spend)


@register("p10_budget_margin", _ctes(*COST_CTES) + f"""
SELECT s.plan_id, {r2('s.budget - e.total_cost')} AS margin,
       CASE WHEN {r2('s.budget - e.total_cost')} >= 0 THEN 'within' ELSE 'over' END AS margin_status
FROM summary s JOIN estimate e ON s.plan_id = e.plan_id
""", ["P10"])
def budget_margin(t: Tables):
    m, st = P.budget_margin("budget", "total_cost")
    return estimate(t, "budget").select("plan_id", m.alias("margin"), st.alias("margin_status"))


@register("p10_budget_page_margin", _ctes(*COST_CTES, ("page", PAGE_SQL)) + """
SELECT plan_id, page_total, difference AS margin, CASE WHEN difference >= 0 THEN 'within' ELSE 'over' END AS margin_status FROM page
""", ["P10"])
def budget_page_margin(t: Tables):
    return _page(t).select("plan_id", "page_total", F.col("difference").alias("margin"),
                           F.when(F.col("difference") >= 0, F.lit("within")).otherwise(F.lit("over")).alias("margin_status"))


@register("p10_checklist_margin", _ctes(*COST_CTES) + f"""
SELECT plan_id, {r2('total')} AS total, {r2('budget - total')} AS margin,
       CASE WHEN total > 0 THEN CASE WHEN {r2('budget - total')} >= 0 THEN 'within' ELSE 'over' END END AS margin_status
FROM (SELECT s.plan_id, s.budget, COALESCE(e.lodging_cost, 0.0) + COALESCE(e.activities_cost, 0.0) + COALESCE(e.transport_cost, 0.0)
             + {r2('(COALESCE(e.lodging_cost, 0.0) + COALESCE(e.activities_cost, 0.0)) * 0.10')} AS total
      FROM summary s LEFT JOIN estimate e ON s.plan_id = e.plan_id) x
""", ["P10"])
def checklist_margin(t: Tables):
    return P.checklist_margin(estimate(t, "budget"))


ITINERARY_SQL = _ctes() + f"""
, acts AS (
  SELECT plan_id, LIST(category ORDER BY category, k) AS acts
  FROM (SELECT plan_id, category, UNNEST(generate_series(1, quantity)) AS k FROM prefs) z GROUP BY plan_id),
days AS (
  SELECT s.plan_id, s.start_date, s.trip_days, a.acts, UNNEST(generate_series(0, s.trip_days - 1)) AS i
  FROM summary s LEFT JOIN acts a ON s.plan_id = a.plan_id)
SELECT plan_id, CAST(i + 1 AS INTEGER) AS day_no, CAST(start_date + CAST(i AS INTEGER) AS DATE) AS day_date,
  CASE WHEN i < COALESCE(len(acts), 0) THEN '{P.MEALS_TEXT} + {P.ACTIVITY_TEXT} ' || acts[i + 1]
       WHEN i = 0 THEN '{P.MEALS_TEXT} + {P.FIRST_DAY_TEXT}'
       WHEN i = trip_days - 1 THEN '{P.MEALS_TEXT} + {P.LAST_DAY_TEXT}'
       ELSE '{P.MEALS_TEXT} + {P.FREE_DAY_TEXT}' END AS suggestion
FROM days
"""


@register("p11_itinerary", ITINERARY_SQL, ["P11"])
def itinerary(t: Tables):
    return P.itinerary(_summary(t), S.prefs(t))


def _checklist_sql() -> str:
    rows = []
    for i, (s, it, q) in enumerate(P.CHECKLIST_ITEMS):
        qty = {None: "CAST(NULL AS INTEGER)", "one": "1",
               "light_clothes": "CAST(GREATEST(CAST(ROUND_EVEN(trip_days * 0.5, 0) AS INTEGER), 2) AS INTEGER)",
               "underwear": "CAST(trip_days + 1 AS INTEGER)",
               "socks": "CAST(GREATEST(trip_days - 1, 1) AS INTEGER)"}[q]
        rows.append(f"SELECT plan_id, {i + 1} AS item_pos, '{s}' AS section, '{it}' AS item, {qty} AS quantity FROM summary")
    pos = len(P.CHECKLIST_ITEMS)
    extra = []
    for kw, items in P.CHECKLIST_EXTRAS:
        for it in items:
            pos += 1
            extra.append(f"SELECT plan_id, {pos} AS item_pos, '{P.EXTRAS_SECTION}' AS section, '{it}' AS item, "
                         f"CAST(NULL AS INTEGER) AS quantity FROM summary WHERE contains(lower(activity_categories), '{kw}')")
    for it in P.LONG_TRIP_EXTRAS:
        pos += 1
        extra.append(f"SELECT plan_id, {pos} AS item_pos, '{P.EXTRAS_SECTION}' AS section, '{it}' AS item, "
                     f"CAST(NULL AS INTEGER) AS quantity FROM summary WHERE trip_days >= {P.LONG_TRIP_DAYS}")
    ex = " UNION ALL ".join(extra)
    placeholder = (f"SELECT plan_id, {pos + 1} AS item_pos, '{P.EXTRAS_SECTION}' AS section, '{P.NO_EXTRAS_ITEM}' AS item, "
                   f"CAST(NULL AS INTEGER) AS quantity FROM summary WHERE plan_id NOT IN (SELECT plan_id FROM ({ex}) e)")
    return _ctes() + " SELECT * FROM (" + " UNION ALL ".join(rows) + f" UNION ALL {ex} UNION ALL {placeholder}) c"


@register("p12_checklist", _checklist_sql(), ["P12"])
def checklist(t: Tables):
    return P.checklist(_summary(t))


_LABELS = (("PROMO", "Turismo cultural"), ("STANDARD", "Naturaleza"), ("LARGE", "Gastronomía"))
_CATS_SQL = "lower(replace(replace(replace(activity_categories, 'PROMO', 'Turismo cultural'), 'STANDARD', 'Naturaleza'), 'LARGE', 'Gastronomía'))"


@register("p12_checklist_extras", _ctes() + f"""
SELECT plan_id, item, CAST(NULL AS INTEGER) AS quantity FROM summary JOIN (VALUES
  ('cultura', 'Libreta para apuntes o recuerdos'), ('cultura', 'Calzado cómodo para caminatas urbanas'),
  ('cultura', 'Espacio libre en celular o cámara'), ('naturaleza', 'Chaqueta ligera'), ('naturaleza', 'Ropa deportiva'),
  ('naturaleza', 'Botella extra de agua'), ('gastronom', 'Presupuesto extra para comidas'),
  ('gastronom', 'Ropa casual para restaurantes')) x(word, item) ON contains({_CATS_SQL}, word)
UNION ALL SELECT plan_id, item, NULL FROM summary, (VALUES ('Recambio adicional de ropa'), ('Bolsa para ropa sucia')) y(item) WHERE trip_days >= 7
UNION ALL SELECT plan_id, 'Sin recomendaciones adicionales por ahora', NULL FROM summary
WHERE trip_days < 7 AND NOT (contains({_CATS_SQL}, 'cultura') OR contains({_CATS_SQL}, 'naturaleza') OR contains({_CATS_SQL}, 'gastronom'))
""", ["P12"])
def checklist_extras(t: Tables):
    """The extras by keyword; the oracle spells the items out."""
    cats = F.col("activity_categories")
    for old, new in _LABELS:
        cats = F.replace(cats, F.lit(old), F.lit(new))
    c = P.checklist(_summary(t).withColumn("activity_categories", cats))
    return c.filter(F.col("section") == P.EXTRAS_SECTION).select("plan_id", "item", "quantity")


def _checklist_state(t: Tables):
    c = P.checklist(_summary(t))
    return c.select("plan_id", "item_pos", ((F.col("plan_id") + F.col("item_pos")) % 3 == 0).alias("done"))


@register("p13_checklist_progress", _ctes(*COST_CTES) + f"""
, state AS (SELECT plan_id, item_pos, ((plan_id + item_pos) % 3 = 0) AS done FROM ({_checklist_sql()}) c),
p AS (SELECT plan_id, COUNT(*) AS n_items, COUNT(*) FILTER (WHERE done) AS n_done FROM state GROUP BY plan_id),
q AS (SELECT *, CASE WHEN n_items > 0 THEN {r2('n_done / n_items * 100')} ELSE 0.0 END AS progress_pct FROM p)
SELECT q.plan_id, q.n_items, q.n_done, q.progress_pct,
  CASE WHEN q.progress_pct = 100 THEN 'complete' WHEN q.progress_pct >= 50 THEN 'advanced' ELSE 'pending' END AS progress_status,
  CASE WHEN e.total_cost > 0 AND s.budget - e.total_cost >= 0 AND q.progress_pct >= 50 THEN 'solid'
       WHEN e.total_cost > 0 AND s.budget - e.total_cost < 0 THEN 'review_budget' ELSE 'incomplete' END AS final_status
FROM q LEFT JOIN estimate e ON q.plan_id = e.plan_id LEFT JOIN summary s ON q.plan_id = s.plan_id
""".replace("WITH summary", "WITH summary", 1), ["P13"])
def checklist_progress(t: Tables):
    return P.checklist_progress(_checklist_state(t), estimate(t, "budget"))


# ----------------------------------------------------- batch plan maintenance
_PLAN_KEY = ["user_id", "origin_country_id", "dest_country_id", "start_date", "end_date", "lodging_category"]
_PLAN_KEY_SQL = ", ".join(_PLAN_KEY)


@register("p14_insert_new_plans", f"""
WITH p AS ({S.PLANS_SQL}),
existing AS (SELECT * FROM p WHERE start_date < DATE '1998-01-01'),
incoming AS (SELECT * FROM p WHERE start_date >= DATE '1997-01-01'
             UNION ALL SELECT * FROM p WHERE start_date >= DATE '2000-01-01'),
batch AS (SELECT * FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY {_PLAN_KEY_SQL} ORDER BY plan_id) AS rn FROM incoming) z
          WHERE rn = 1)
SELECT plan_id, {_PLAN_KEY_SQL} FROM batch b
WHERE NOT EXISTS (SELECT 1 FROM existing e WHERE """ + " AND ".join(f"e.{k} = b.{k}" for k in _PLAN_KEY) + ")",
          ["P14", "K1", "J4"])
def p14(t: Tables):
    p = S.plans(t)
    existing = p.filter(F.col("start_date") < F.lit("1998-01-01").cast("date"))
    incoming = (p.filter(F.col("start_date") >= F.lit("1997-01-01").cast("date"))
                .unionByName(p.filter(F.col("start_date") >= F.lit("2000-01-01").cast("date"))))
    return P.insert_new(existing, incoming, _PLAN_KEY, ["plan_id"]).select("plan_id", *_PLAN_KEY)


@register("p15_upsert_preferences", f"""
WITH pr AS ({S.PREFS_SQL}),
existing AS (SELECT plan_id, category, quantity, 0 AS version FROM pr),
incoming AS (SELECT plan_id, category, quantity + 1 AS quantity, 1 AS version FROM pr WHERE category = 'PROMO'),
u AS (SELECT * FROM existing UNION ALL SELECT * FROM incoming)
SELECT plan_id, category, quantity, version FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY plan_id, category ORDER BY version DESC) AS rn FROM u) z WHERE rn = 1""",
          ["P15", "K3"])
def p15(t: Tables):
    pr = S.prefs(t)
    existing = pr.withColumn("version", F.lit(0))
    incoming = pr.filter(F.col("category") == "PROMO").select(
        "plan_id", "category", (F.col("quantity") + 1).alias("quantity"), F.lit(1).alias("version"))
    return P.upsert(existing, incoming, ["plan_id", "category"], "version").select("plan_id", "category", "quantity", "version")


@register("p16_validated_ledger", f"""
SELECT entry_id, plan_id, amount, CASE WHEN plan_id IS NULL THEN 'plan_not_null' WHEN NOT (amount >= 0) THEN 'amount_non_negative' END AS rejected_rule
FROM (SELECT event_id AS entry_id, CASE WHEN event_type = 'error' THEN NULL ELSE user_id END AS plan_id,
             CASE WHEN event_type = 'click' THEN -value ELSE value END AS amount FROM events) z""", ["P16", "Q16"])
def p16(t: Tables):
    e = S.ledger(t).select("entry_id", F.when(F.col("category") != "error", F.col("plan_id")).alias("plan_id"),
                           F.when(F.col("category") == "click", -F.col("amount")).otherwise(F.col("amount")).alias("amount"))
    ok, bad = P.append_validated(e)
    return ok.withColumn("rejected_rule", F.lit(None).cast("string")).unionByName(bad)


@register("p17_cascade_delete", f"""
SELECT s.plan_id, s.stop_order, s.province_id FROM ({S.STOPS_SQL}) s
WHERE s.plan_id IN (SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'P')""", ["P17"])
def p17(t: Tables):
    surviving = t.orders.filter(F.col("o_orderstatus") != "P").select(F.col("o_orderkey").alias("plan_id"))
    return P.cascade_keep(S.stops(t), surviving)


@register("p18_plan_rule_violations", f"""
WITH p AS (SELECT plan_id, user_id, origin_country_id, dest_country_id, start_date,
                  CASE WHEN plan_id % 17 = 0 THEN CAST(start_date - 1 AS DATE) ELSE end_date END AS end_date,
                  CASE WHEN plan_id % 19 = 0 THEN -budget ELSE budget END AS budget FROM ({S.PLANS_SQL}) x)
SELECT plan_id, 'end_not_before_start' AS rule FROM p WHERE NOT COALESCE(end_date >= start_date, FALSE)
UNION ALL SELECT plan_id, 'budget_non_negative' FROM p WHERE NOT COALESCE(budget >= 0, FALSE)
UNION ALL SELECT plan_id, 'user_required' FROM p WHERE user_id IS NULL""", ["P18", "Q16"])
def p18(t: Tables):
    p = S.plans(t)
    p = p.withColumn("end_date", F.when(F.col("plan_id") % 17 == 0, F.date_sub("start_date", 1)).otherwise(F.col("end_date")))
    p = p.withColumn("budget", F.when(F.col("plan_id") % 19 == 0, -F.col("budget")).otherwise(F.col("budget")))
    return P.plan_rule_violations(p)


@register("p19_pick_lists", f"""
SELECT 'country' AS list, CAST(country_id AS VARCHAR) AS code, country_name AS label FROM ({S.COUNTRIES_SQL}) c
UNION ALL SELECT 'province', CAST(province_id AS VARCHAR), province_name FROM ({S.PROVINCES_SQL}) p
UNION ALL SELECT DISTINCT 'lodging_category', category, category FROM ({S.LODGING_FACT_SQL}) f WHERE category IS NOT NULL AND category <> ''
UNION ALL SELECT 'activity_category', category, category FROM ({M2_SQL}) r
  WHERE {S.cost_group_sql('category')} = 'actividades' GROUP BY category""", ["P19", "U4", "T6", "T1"])
def p19(t: Tables):
    from ..operators.topk import keys_by_aggregate
    c = S.countries(t).select(F.lit("country").alias("list"), F.col("country_id").cast("string").alias("code"),
                              F.col("country_name").alias("label"))
    pv = S.provinces(t).select(F.lit("province").alias("list"), F.col("province_id").cast("string").alias("code"),
                               F.col("province_name").alias("label"))
    lc = (S.lodging_fact(t).select("category").filter(F.col("category").isNotNull() & (F.col("category") != ""))
          .distinct().select(F.lit("lodging_category").alias("list"), F.col("category").alias("code"),
                             F.col("category").alias("label")))
    rec = M.with_cost_group(_activity_rec(t), S.COST_GROUPS).filter(F.col("cost_group") == "actividades")
    ac = keys_by_aggregate(rec, "category", F.sum("n_rows")).select(
        F.lit("activity_category").alias("list"), F.col("category").alias("code"), F.col("category").alias("label"))
    return c.unionByName(pv).unionByName(lc).unionByName(ac)
