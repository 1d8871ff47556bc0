"""The model's views over stand-in tables, read by SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..plans.views import model_views
from ..tables import Tables
from . import standins as S
from .planning import COST_CTES, NIGHTS_SQL, SPEND_SQL, _ctes
from .registry import register
from .sqlutil import r2

VIEWS = model_views(S.FOOD_CATEGORY, S.COST_GROUPS)


def base_tables(t: Tables) -> dict:
    """Municipalities are customers (their points lack every tenth row and
    some coordinates), islands are suppliers."""
    customers = t.customer.select("c_custkey", "c_name", "c_nationkey").join(
        t.nation.select("n_nationkey", "n_regionkey"), F.col("c_nationkey") == F.col("n_nationkey"), "left")
    points = S.customer_geo(t).filter("c_custkey % 10 <> 0").select(
        F.col("c_custkey").alias("municipality_id"), F.when(F.col("c_custkey") % 7 != 0, F.col("lat")).alias("lat"), "lon")
    suppliers = t.supplier.select("s_suppkey", "s_nationkey").join(
        t.nation.select("n_nationkey", "n_regionkey"), F.col("s_nationkey") == F.col("n_nationkey"), "left")
    return {
        "countries": S.countries(t), "provinces": S.provinces(t),
        "municipalities": customers.select(F.col("c_custkey").alias("municipality_id"), F.col("c_name").alias("municipality_name"),
                                           F.col("c_nationkey").alias("province_id"), F.col("n_regionkey").alias("country_id")),
        "islands": suppliers.select(F.col("s_suppkey").alias("island_id"), F.col("s_nationkey").alias("province_id"),
                                    F.col("n_regionkey").alias("country_id")),
        "municipality_points": points,
        "lodging_fact": S.lodging_fact(t), "activity_fact": S.activity_fact(t),
        "plans": S.plans(t), "stops": S.stops(t), "prefs": S.prefs(t), "ledger": S.ledger(t),
    }


def _sql(t: Tables, query: str, *views: str):
    VIEWS.register(t.spark, base_tables(t), views)
    return t.spark.sql(query)


@register("io8_view_cost_estimate", _ctes(*COST_CTES) + " SELECT * FROM estimate", ["IO8", "P7"])
def view_cost_estimate(t: Tables):
    return _sql(t, "SELECT * FROM plan_cost_estimate", "plan_cost_estimate")


@register("io8_view_budget_by_country", _ctes(*COST_CTES, ("spend", SPEND_SQL)) + f"""
SELECT s.dest_country, COUNT(*) AS n_plans, {r2('SUM(e.total_cost)')} AS total_cost,
       CAST(COUNT(*) FILTER (WHERE g.spent_total > s.budget) AS BIGINT) AS n_overspent
FROM summary s JOIN estimate e ON s.plan_id = e.plan_id LEFT JOIN spend g ON g.plan_id = s.plan_id
GROUP BY s.dest_country""", ["IO8", "P1", "P7", "A25"])
def view_budget_by_country(t: Tables):
    """A user's own SQL over three views: the summary's text columns are pruned away."""
    return _sql(t, """
        SELECT s.dest_country, COUNT(*) AS n_plans, CAST(ROUND(CAST(SUM(e.total_cost) AS DECIMAL(38, 6)), 2) AS DOUBLE) AS total_cost,
               COUNT_IF(g.spent_total > s.budget) AS n_overspent
        FROM plan_summary s JOIN plan_cost_estimate e ON s.plan_id = e.plan_id LEFT JOIN plan_spend g ON g.plan_id = s.plan_id
        GROUP BY s.dest_country""", "plan_summary", "plan_cost_estimate", "plan_spend")


@register("io8_view_point_coverage", """
WITH m AS (SELECT c.c_custkey AS id, n.n_regionkey AS country_id FROM customer c LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey)
SELECT country_id, COUNT(*) AS n_municipalities, COUNT(*) FILTER (WHERE id % 10 <> 0 AND id % 7 <> 0) AS n_with_point,
       ROUND(100.0 * COUNT(*) FILTER (WHERE id % 10 <> 0 AND id % 7 <> 0) / COUNT(*), 2) AS coverage_pct
FROM m GROUP BY country_id""", ["IO8", "Q6", "A7"])
def view_point_coverage(t: Tables):
    return _sql(t, "SELECT * FROM point_coverage", "point_coverage")


_QA = {
    "qa_countries_duplicates": "SELECT 0 FROM region GROUP BY r_regionkey HAVING COUNT(*) > 1",
    "qa_provinces_duplicates": "SELECT 0 FROM nation GROUP BY n_regionkey, n_name HAVING COUNT(*) > 1",
    "qa_provinces_country_missing": "SELECT 0 FROM nation WHERE n_regionkey NOT IN (SELECT r_regionkey FROM region)",
    "qa_municipalities_province_missing": "SELECT 0 FROM customer WHERE c_nationkey NOT IN (SELECT n_nationkey FROM nation)",
    "qa_lodging_fact_month_invalid": f"SELECT 0 FROM ({S.LODGING_FACT_SQL}) f WHERE month NOT BETWEEN 1 AND 12",
    "qa_activity_fact_province_missing": f"SELECT 0 FROM ({S.ACTIVITY_FACT_SQL}) f WHERE province_id NOT IN (SELECT n_nationkey FROM nation)",
    "qa_municipality_points_null_coordinates": "SELECT 0 FROM customer WHERE c_custkey % 10 <> 0 AND c_custkey % 7 = 0",
    "qa_municipalities_without_point": "SELECT 0 FROM customer WHERE c_custkey % 10 = 0 OR c_custkey % 7 = 0",
}


@register("io8_view_quality_counts", " UNION ALL ".join(f"SELECT '{v}' AS report, COUNT(*) AS n_rows FROM ({q}) x" for v, q in _QA.items()),
          ["IO8", "Q1", "Q2", "Q4", "Q5"])
def view_quality_counts(t: Tables):
    """Rows of several quality views in one statement."""
    return _sql(t, " UNION ALL ".join(f"SELECT '{v}' AS report, COUNT(*) AS n_rows FROM {v}" for v in _QA), *_QA)


@register("d2_night_series", _ctes() + """
SELECT plan_id, CAST(night AS DATE) AS night_date, dayofweek(night) IN (5, 6) AS is_weekend
FROM (SELECT s.plan_id, UNNEST(generate_series(CAST(s.start_date AS TIMESTAMP), CAST(s.end_date AS TIMESTAMP) - INTERVAL 1 DAY,
      INTERVAL 1 DAY)) AS night FROM summary s) x""", ["D-2", "J13", "IO8"])
def night_series(t: Tables):
    return _sql(t, "SELECT * FROM plan_night_dates", "plan_night_dates")


@register("d2_nights_from_series", _ctes() + NIGHTS_SQL, ["D-2", "P2", "A8"])
def nights_from_series(t: Tables):
    """The split of P2 counted on the exploded nights."""
    return _sql(t, """SELECT plan_id, CAST(COUNT(*) AS INT) AS nights_total, CAST(COUNT_IF(is_weekend) AS INT) AS nights_weekend,
                             CAST(COUNT_IF(NOT is_weekend) AS INT) AS nights_weekday
                      FROM plan_night_dates GROUP BY plan_id""", "plan_night_dates")
