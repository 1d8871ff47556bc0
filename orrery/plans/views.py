"""The named views of the model, for users who write SQL.

A view is SQL text or a builder over DataFrames, with the tables and views it
reads declared as parents. A catalog registers the wanted views and their
ancestors in dependency order as temporary views over the base tables, so
``SELECT * FROM plan_cost_estimate`` works in ``spark.sql``. Views are lazy:
Catalyst sees the whole plan behind a view, prunes columns and pushes filters
through it; nothing is computed or stored by registering.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import aggregates as A
from ..operators.joins import counts_per_parent
from . import planning as P
from . import recipes as M


class ViewError(ValueError):
    pass


@dataclass(frozen=True)
class View:
    """``definition``: SQL text, or a function that takes the parents as
    DataFrames in the order of ``parents``."""
    name: str
    parents: tuple[str, ...]
    definition: str | Callable[..., DataFrame]


class ViewCatalog:
    def __init__(self, views: Iterable[View] = ()):
        self._views: dict[str, View] = {}
        for v in views:
            self.add(v)

    def add(self, view: View) -> None:
        if view.name in self._views:
            raise ViewError(f"view {view.name} is defined twice")
        self._views[view.name] = view

    def names(self) -> list[str]:
        return list(self._views)

    def order(self, tables: Iterable[str], wanted: Iterable[str] | None = None) -> list[str]:
        """The wanted views (all by default) and the views they need, parents
        first. Raises ``ViewError`` for a name that is neither a table nor a
        view, for a cycle, and for a view that hides a table."""
        base, done, path = set(tables), [], []

        def visit(name: str, child: str) -> None:
            if name in path:
                raise ViewError("views read each other in a circle: " + " -> ".join([*path[path.index(name):], name]))
            if name in done or name in base and name not in self._views:
                return
            if name not in self._views:
                raise ViewError(f"{child} reads {name}, which is no table and no view")
            if name in base:
                raise ViewError(f"view {name} has the name of a table")
            path.append(name)
            for p in self._views[name].parents:
                visit(p, name)
            path.pop()
            done.append(name)
        for name in self._views if wanted is None else wanted:
            visit(name, "the query")
        return done

    def register(self, spark: SparkSession, tables: Mapping[str, DataFrame], wanted: Iterable[str] | None = None) -> list[str]:
        """Create the temporary views of the base tables they read and of the
        wanted views, parents first; returns the views' names in that order."""
        order = self.order(tables, wanted)
        read = {p for name in order for p in self._views[name].parents}
        frames = {name: tables[name] for name in tables if name in read or wanted is None}
        for name, df in frames.items():
            df.createOrReplaceTempView(name)
        for name in order:
            view = self._views[name]
            if isinstance(view.definition, str):
                frames[name] = spark.sql(view.definition)
            else:
                frames[name] = view.definition(*[frames[p] for p in view.parents])
            frames[name].createOrReplaceTempView(name)
        return order


def _duplicates(table: str, *keys: str) -> View:
    ks = ", ".join(keys)
    return View(f"qa_{table}_duplicates", (table,), f"SELECT {ks}, COUNT(*) AS n FROM {table} GROUP BY {ks} HAVING COUNT(*) > 1")


def _missing(child: str, key: str, parent: str, what: str, optional: bool = False) -> View:
    """Rows of the child whose key has no parent; a null key counts unless optional."""
    nulls = f" AND c.{key} IS NOT NULL" if optional else ""
    return View(f"qa_{child}_{what}_missing", (child, parent),
                f"SELECT c.* FROM {child} c LEFT ANTI JOIN {parent} p ON c.{key} = p.{key} WHERE TRUE{nulls}")


def _null_coordinates(table: str) -> View:
    return View(f"qa_{table}_null_coordinates", (table,), f"SELECT * FROM {table} WHERE lat IS NULL OR lon IS NULL")


BASE_TABLES = ("countries", "provinces", "municipalities", "islands", "municipality_points", "lodging_fact", "activity_fact",
               "plans", "stops", "prefs", "ledger")
FACTS = ("lodging_fact", "activity_fact")


def _estimate(core: DataFrame, prefs: DataFrame, lodging: DataFrame, activities: DataFrame, food_category: str, rules) -> DataFrame:
    return P.estimate_from_core(core, prefs, lodging, activities, food_category, rules)


def model_views(food_category: str = P.FOOD_CATEGORY, cost_groups: Mapping[str, str] = M.COST_GROUP_RULES) -> ViewCatalog:
    """The views of the model over ``BASE_TABLES``: recommendations, plan
    summary, cost chain, ledger totals, dashboard counts, pick lists and
    quality reports."""
    group_cost = lambda column: (lambda core, prefs, rec: P.group_costs(core, prefs, rec, cost_groups)
                                 .filter(F.col(column).isNotNull()).select("plan_id", column))
    counted = [t for t in BASE_TABLES if t not in ("plans", "stops", "prefs", "ledger")]
    return ViewCatalog([
        # Recommendations.
        View("lodging_prices", ("lodging_fact", "provinces"), M.price_by_province),
        View("activity_prices", ("activity_fact", "provinces"), M.activities_by_province),
        View("activity_cost_groups", ("activity_prices",), lambda rec: M.with_cost_group(rec, cost_groups)),
        # Plans and their costs.
        View("plan_core", ("plans", "stops", "countries", "provinces"), P.plan_core),
        View("plan_summary", ("plans", "stops", "prefs", "countries", "provinces"), P.plan_summary),
        View("plan_nights", ("plan_core",), P.nights_by_day_type),
        View("plan_night_dates", ("plan_core",), P.night_series),
        View("plan_lodging_cost", ("plan_core", "lodging_prices"), P.lodging_cost),
        View("plan_food_cost", ("plan_core", "activity_prices"), lambda core, rec: P.food_cost(core, rec, food_category)),
        View("plan_activities_cost", ("plan_core", "prefs", "activity_prices"), group_cost("activities_cost")),
        View("plan_services_cost", ("plan_core", "prefs", "activity_prices"), group_cost("services_cost")),
        View("plan_other_cost", ("plan_core", "prefs", "activity_prices"), group_cost("other_cost")),
        View("plan_cost_estimate", ("plan_core", "prefs", "lodging_prices", "activity_prices"),
             lambda core, prefs, lodging, activities: _estimate(core, prefs, lodging, activities, food_category, cost_groups)),
        View("plan_transport_cost", ("plan_cost_estimate",), "SELECT plan_id, transport_cost FROM plan_cost_estimate"),
        View("plan_spend", ("ledger",), lambda ledger: A.totals_per_key(ledger, ["plan_id"], "amount", total_col="spent_total")),
        View("plan_spend_by_category", ("ledger",), lambda ledger: A.totals_per_key(ledger, ["plan_id", "category"], "amount", total_col="spent")),
        View("plan_spend_detail", ("ledger",), "SELECT * FROM ledger"),
        # Dashboard counts and pick lists.
        View("table_counts", tuple(counted), lambda *frames: A.table_counts(dict(zip(counted, frames)))),
        View("country_detail", ("countries", "provinces", "municipalities", "islands"),
             lambda c, p, m, i: counts_per_parent(c, "country_id", {"n_provinces": (p, "country_id"), "n_municipalities": (m, "country_id"),
                                                                    "n_islands": (i, "country_id")})),
        View("global_counts", ("country_detail",), "SELECT COUNT(*) AS n_countries, SUM(n_provinces) AS n_provinces, "
             "SUM(n_municipalities) AS n_municipalities, SUM(n_islands) AS n_islands FROM country_detail"),
        View("country_list", ("countries",), "SELECT country_id, country_name FROM countries ORDER BY country_name"),
        View("province_list", ("provinces",), "SELECT country_id, province_id, province_name FROM provinces ORDER BY country_id, province_name"),
        View("lodging_category_list", ("lodging_fact",), "SELECT DISTINCT category FROM lodging_fact WHERE category IS NOT NULL ORDER BY category"),
        View("activity_category_list", ("activity_cost_groups",), "SELECT category FROM activity_cost_groups WHERE cost_group = 'actividades' "
             "GROUP BY category ORDER BY SUM(n_rows) DESC, category"),
        # Quality reports.
        _duplicates("countries", "country_id"),
        _duplicates("provinces", "country_id", "province_name"),
        _duplicates("lodging_fact", "country_id", "province_id", "supplier_id", "month", "category"),
        View("qa_lodging_fact_month_invalid", ("lodging_fact",), "SELECT * FROM lodging_fact WHERE month IS NULL OR month NOT BETWEEN 1 AND 12"),
        _missing("provinces", "country_id", "countries", "country"),
        _missing("municipalities", "country_id", "countries", "country"),
        _missing("municipalities", "province_id", "provinces", "province"),
        _missing("islands", "province_id", "provinces", "province", optional=True),
        _missing("activity_fact", "province_id", "provinces", "province"),
        _missing("lodging_fact", "province_id", "provinces", "province"),
        _missing("municipality_points", "municipality_id", "municipalities", "municipality"),
        _null_coordinates("municipality_points"),
        View("qa_municipalities_without_point", ("municipalities", "municipality_points"),
             "SELECT m.* FROM municipalities m LEFT ANTI JOIN municipality_points g "
             "ON m.municipality_id = g.municipality_id AND g.lat IS NOT NULL AND g.lon IS NOT NULL"),
        View("point_coverage", ("municipalities", "qa_municipalities_without_point"),
             "SELECT a.country_id, a.n AS n_municipalities, a.n - COALESCE(w.n, 0) AS n_with_point, "
             "ROUND(100.0D * (a.n - COALESCE(w.n, 0)) / a.n, 2) AS coverage_pct "
             "FROM (SELECT country_id, COUNT(*) AS n FROM municipalities GROUP BY country_id) a LEFT JOIN "
             "(SELECT country_id, COUNT(*) AS n FROM qa_municipalities_without_point GROUP BY country_id) w ON a.country_id <=> w.country_id"),
    ])
