"""Batch trip planning and budget, P1-P19, for all plans at once.

Every component is keyed by ``plan_id``. The plan summary (P1) is built
once and passed to the component builders; each component is an aggregate
grouped by ``plan_id``, so the final assembly joins inputs that are
hash-partitioned the same way. Reference tables (price per province and
category) are small aggregates that Catalyst / AQE broadcast by size.
Rounding is stepwise, as in the reference views: a component is rounded
before it feeds the next one.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import dates as D
from ..functions.common import ColumnOrName, col, round_half_up, safe_div
from ..operators.aggregates import ordered_string_agg
from ..operators.keys import keep_first_per_key, keep_last_per_key
from ..operators.quality import rule_violations, split_valid
from .recipes import COST_GROUP_DEFAULT, COST_GROUP_RULES, cost_group

# Fixed values of the cost model.
FOOD_CATEGORY = "comida y bebida"
FOOD_DAILY_FACTOR = 0.12
TRANSPORT_FACTOR = 0.08
OTHER_FACTOR = 0.10
COST_COMPONENTS = ("lodging_cost", "food_cost", "activities_cost", "services_cost", "other_cost", "transport_cost")
# cost group label -> estimate column
GROUP_COLUMNS = {"actividades": "activities_cost", "servicios": "services_cost", "otros": "other_cost"}


def plan_core(plans: DataFrame, stops: DataFrame, countries: DataFrame, provinces: DataFrame) -> DataFrame:
    """The plan rows of P1 without the preference text: both countries
    (inner joins, as the view), the main destination (stop 1, left join),
    trip days and nights. Cost components start from this lean table."""
    c = countries.select("country_id", "country_name")
    origin = c.select(F.col("country_id").alias("origin_country_id"), F.col("country_name").alias("origin_country"))
    dest = c.select(F.col("country_id").alias("dest_country_id"), F.col("country_name").alias("dest_country"))
    main = (stops.filter(F.col("stop_order") == 1)
            .join(provinces.select("province_id", "province_name"), "province_id", "inner")
            .select("plan_id", F.col("province_id").alias("dest_province_id"),
                    F.col("province_name").alias("dest_province")))
    j = plans.join(origin, "origin_country_id", "inner").join(dest, "dest_country_id", "inner").join(main, "plan_id", "left")
    return j.select(
        "plan_id", "user_id", "origin_country_id", "origin_country", "dest_country_id", "dest_country",
        "dest_province_id", "dest_province", "start_date", "end_date",
        D.trip_days("start_date", "end_date").alias("trip_days"),
        D.trip_nights("start_date", "end_date").alias("trip_nights"),
        "budget", "trip_type", "lodging_category", "created_at",
    )


def plan_summary(plans: DataFrame, stops: DataFrame, prefs: DataFrame, countries: DataFrame,
                 provinces: DataFrame) -> DataFrame:
    """Plan header with both country names (J3), main destination
    (stop 1) and its name, trip days / nights (D-1) and the ordered
    preference text ``category (n), ...`` (A13, '' when none)."""
    core = plan_core(plans, stops, countries, provinces)
    cats = ordered_string_agg(prefs, ["plan_id"], "category", "quantity", out="activity_categories")
    j = core.join(cats, "plan_id", "left")
    cols = [c for c in core.columns if c != "created_at"]
    return j.select(*cols, F.coalesce(F.col("activity_categories"), F.lit("")).alias("activity_categories"),
                    "created_at")


def _nights_cols(start: str = "start_date", nights: str = "trip_nights") -> list[Column]:
    """Total / weekend / weekday nights computed per row (no series)."""
    n = F.greatest(F.col(nights), F.lit(0))
    we = D.count_weekdays(start, n, D.WEEKEND_DAYS)
    return [n.cast("int").alias("nights_total"), we.alias("nights_weekend"), (n - we).cast("int").alias("nights_weekday")]


def nights_by_day_type(summary: DataFrame) -> DataFrame:
    """One row per plan with at least one night: total, weekend
    (Friday and Saturday nights) and weekday nights. Computed from the
    start weekday and the night count, so it is a narrow projection (the
    generated day series of the reference, ``night_dates``, is not needed)."""
    return summary.filter(F.col("trip_nights") > 0).select("plan_id", *_nights_cols())


def night_series(summary: DataFrame, weekend_days: Sequence[int] = D.WEEKEND_DAYS) -> DataFrame:
    """D-2 / J13: one row per plan and night (start .. end - 1) with its date
    and whether it is a weekend night; plans without nights have no row."""
    return summary.select("plan_id", F.explode(D.night_dates("start_date", "end_date")).alias("night_date")).select(
        "plan_id", "night_date", D.is_weekend_night("night_date", weekend_days).alias("is_weekend"))


def _lodging_rec(lodging_rec: DataFrame, category_col: str = "category") -> DataFrame:
    return lodging_rec.select(F.col("country_id").alias("dest_country_id"),
                              F.col("province_id").alias("dest_province_id"),
                              F.col(category_col).alias("lodging_category"),
                              F.col("avg_weekday").alias("night_price_weekday"),
                              F.col("avg_weekend").alias("night_price_weekend"))


def _with_lodging(core: DataFrame, lodging_rec: DataFrame, category_col: str = "category") -> DataFrame:
    """Nights by type and the lodging estimate as columns of the plan rows
    (the reference table is a small aggregate)."""
    has = F.col("trip_nights") > 0
    j = core.join(_lodging_rec(lodging_rec, category_col), ["dest_country_id", "dest_province_id", "lodging_category"], "left")
    n = F.greatest(F.col("trip_nights"), F.lit(0))
    we = D.count_weekdays("start_date", n, D.WEEKEND_DAYS)
    # The reference's per-plan night counts exist only for plans with nights.
    j = j.select("*", F.when(has, n.cast("int")).alias("nights_total"), F.when(has, we).alias("nights_weekend"),
                 F.when(has, (n - we).cast("int")).alias("nights_weekday"))
    z = lambda c: F.coalesce(F.col(c), F.lit(0))
    est = z("night_price_weekday") * z("nights_weekday") + z("night_price_weekend") * z("nights_weekend")
    return j.withColumn("lodging_cost", round_half_up(est))


def lodging_cost(summary: DataFrame, lodging_rec: DataFrame, category_col: str = "category") -> DataFrame:
    """Weekday nights x weekday price + weekend nights x weekend price
    for the destination and lodging category; unknown parts count 0."""
    j = _with_lodging(summary, lodging_rec, category_col)
    return j.select("plan_id", "trip_nights", "nights_weekday", "nights_weekend", "lodging_category",
                    "night_price_weekday", "night_price_weekend", "lodging_cost")


def _food_reference(activity_rec: DataFrame, food_category: str) -> DataFrame:
    rec = activity_rec.filter(F.lower(F.trim("category")) == food_category.strip().lower())
    return rec.groupBy(F.col("country_id").alias("dest_country_id"), F.col("province_id").alias("dest_province_id")).agg(
        round_half_up(F.avg("avg_entry_price")).alias("food_reference"))


def _with_food(core: DataFrame, activity_rec: DataFrame, food_category: str, daily_factor: float) -> DataFrame:
    """Food estimate as columns of the plan rows. The per-plan mean of the
    destination's food rows equals the mean per destination, so the
    reference is aggregated per destination (small) and joined."""
    j = core.join(_food_reference(activity_rec, food_category), ["dest_country_id", "dest_province_id"], "left")
    ref = F.coalesce(F.col("food_reference"), F.lit(0.0))
    return (j.withColumn("food_daily", round_half_up(ref * daily_factor))
            .withColumn("food_cost", round_half_up(ref * daily_factor * F.col("trip_days"))))


def food_cost(summary: DataFrame, activity_rec: DataFrame, food_category: str = FOOD_CATEGORY,
              daily_factor: float = FOOD_DAILY_FACTOR) -> DataFrame:
    """Rounded mean entry price of the food category at the
    destination, x factor per day, x days."""
    j = _with_food(summary, activity_rec, food_category, daily_factor)
    return j.select("plan_id", "trip_days", "food_reference", "food_daily", "food_cost")


def group_costs(summary: DataFrame, prefs: DataFrame, activity_rec: DataFrame,
                rules: Mapping[str, str] = COST_GROUP_RULES, default: str = COST_GROUP_DEFAULT,
                group_columns: Mapping[str, str] = GROUP_COLUMNS) -> DataFrame:
    """P5: for each preferred category of a cost group: rounded mean entry
    price at the destination x quantity, summed per plan and group; the
    three groups in one pass. Plans with no priced preference in a group
    get null for it (as the views)."""
    rec = (activity_rec.withColumn("cost_group", cost_group("category", rules, default))
           .filter(F.col("cost_group").isin(list(group_columns)))
           .groupBy(F.col("country_id").alias("dest_country_id"), F.col("province_id").alias("dest_province_id"),
                    "category", "cost_group")
           .agg(round_half_up(F.avg("avg_entry_price")).alias("category_price")))
    j = (summary.select("plan_id", "dest_country_id", "dest_province_id")
         .join(prefs.select("plan_id", "category", "quantity"), "plan_id", "inner")
         .join(rec, ["dest_country_id", "dest_province_id", "category"], "inner"))
    aggs = [round_half_up(F.sum(F.when(F.col("cost_group") == g, F.col("category_price") * F.col("quantity")))).alias(c)
            for g, c in group_columns.items()]
    return j.groupBy("plan_id").agg(*aggs)


def transport_cost(parts: DataFrame, factor: float = TRANSPORT_FACTOR) -> DataFrame:
    """Factor x (lodging + food + activities + services), not other."""
    z = lambda c: F.coalesce(F.col(c), F.lit(0.0))
    base = z("lodging_cost") + z("food_cost") + z("activities_cost") + z("services_cost")
    return parts.select("plan_id", round_half_up(base * factor).alias("transport_cost"))


def _finish_estimate(j: DataFrame, transport_factor: float, carry: Sequence[str] = ()) -> DataFrame:
    z = lambda c: F.coalesce(F.col(c), F.lit(0.0))
    transport = round_half_up((z("lodging_cost") + z("food_cost") + z("activities_cost") + z("services_cost"))
                              * transport_factor)
    j = j.select("plan_id", "trip_days", "trip_nights", *carry,
                 *[z(c).alias(c) for c in COST_COMPONENTS[:-1]], transport.alias("transport_cost"))
    total = None
    for c in COST_COMPONENTS:
        total = F.col(c) if total is None else total + F.col(c)
    return j.withColumn("total_cost", round_half_up(total))


def estimate_all(plans: DataFrame, stops: DataFrame, prefs: DataFrame, countries: DataFrame,
                 provinces: DataFrame, lodging_rec: DataFrame, activity_rec: DataFrame,
                 food_category: str = FOOD_CATEGORY, rules: Mapping[str, str] = COST_GROUP_RULES,
                 daily_factor: float = FOOD_DAILY_FACTOR, transport_factor: float = TRANSPORT_FACTOR,
                 carry: Sequence[str] = ()) -> DataFrame:
    """P1-P7 in one plan; ``carry`` adds columns of the plan core (budget,
    start date), so that P8-P10 and P13 need no second core. The lean plan core is built once; nights, lodging
    and food are columns added to it through joins with small reference
    aggregates (no shuffle of the plans beyond the core itself); only the
    preference-based group costs are an aggregate by ``plan_id`` joined back.
    """
    return estimate_from_core(plan_core(plans, stops, countries, provinces), prefs, lodging_rec, activity_rec,
                              food_category, rules, daily_factor, transport_factor, carry)


def estimate_from_core(core: DataFrame, prefs: DataFrame, lodging_rec: DataFrame, activity_rec: DataFrame,
                       food_category: str = FOOD_CATEGORY, rules: Mapping[str, str] = COST_GROUP_RULES,
                       daily_factor: float = FOOD_DAILY_FACTOR, transport_factor: float = TRANSPORT_FACTOR,
                       carry: Sequence[str] = ()) -> DataFrame:
    """P3-P7 from the plan core."""
    rows = _with_food(_with_lodging(core, lodging_rec), activity_rec, food_category, daily_factor)
    groups = group_costs(core, prefs, activity_rec, rules)
    j = rows.select("plan_id", "trip_days", "trip_nights", *carry, "lodging_cost", "food_cost").join(groups, "plan_id", "left")
    return _finish_estimate(j, transport_factor, carry)


def budget_page(estimate: DataFrame, as_of: ColumnOrName, other_factor: float = OTHER_FACTOR) -> DataFrame:
    """Budget page: other = factor x (lodging + activities), transport 0,
    cost per day, difference to the user budget, months left and the
    monthly saving goal. ``estimate`` carries budget and start_date."""
    j = estimate
    lod = F.coalesce(F.col("lodging_cost"), F.lit(0.0))
    act = F.coalesce(F.col("activities_cost"), F.lit(0.0))
    other = round_half_up((lod + act) * other_factor)
    total = lod + act + other
    months = D.months_until("start_date", as_of)
    return j.select(
        "plan_id", "budget", lod.alias("lodging_cost"), act.alias("activities_cost"), other.alias("other_cost"),
        F.lit(0.0).alias("transport_cost"), round_half_up(total).alias("page_total"),
        F.when(F.col("trip_days") > 0, round_half_up(safe_div(total, "trip_days"))).otherwise(F.lit(0.0)).alias("cost_per_day"),
        round_half_up(F.col("budget") - total).alias("difference"),
        D.days_until("start_date", as_of).alias("days_left"), months.alias("months_left"),
        round_half_up(safe_div(total, months)).alias("monthly_saving"),
    )


def saving_schedule(page: DataFrame) -> DataFrame:
    """One row per remaining month with the saving goal."""
    return page.select("plan_id", F.explode(F.sequence(F.lit(1), F.col("months_left"))).alias("month_no"),
                       "monthly_saving")


def approved_budget(estimate: DataFrame, spend_totals: DataFrame, other_factor: float = OTHER_FACTOR) -> DataFrame:
    """approved = lodging + activities + transport + factor x (lodging +
    activities); executed % of it; traffic light (<80, <=100, >100)."""
    j = estimate.select("plan_id", "lodging_cost", "activities_cost", "transport_cost").join(
        spend_totals.select("plan_id", "spent_total"), "plan_id", "left")
    lod, act = F.coalesce(F.col("lodging_cost"), F.lit(0.0)), F.coalesce(F.col("activities_cost"), F.lit(0.0))
    tr = F.coalesce(F.col("transport_cost"), F.lit(0.0))
    other = round_half_up((lod + act) * other_factor)
    approved = lod + act + tr + other
    spent = F.coalesce(F.col("spent_total"), F.lit(0.0))
    executed = F.when(approved > 0, round_half_up(safe_div(spent, approved) * 100)).otherwise(F.lit(0.0))
    status = F.when(executed < 80, "within").when(executed <= 100, "near_limit").otherwise("exceeded")
    return j.select("plan_id", round_half_up(approved).alias("approved_budget"), spent.alias("spent_total"),
                    round_half_up(approved - spent).alias("remaining"), executed.alias("executed_pct"),
                    status.alias("status"))


def checklist_margin(estimate: DataFrame, other_factor: float = OTHER_FACTOR) -> DataFrame:
    """P10, third basis: budget minus (lodging + activities + the estimate's
    transport + factor x (lodging + activities)); the label is given only to
    plans that cost something. ``estimate`` carries the budget."""
    j = estimate
    z = lambda c: F.coalesce(F.col(c), F.lit(0.0))
    both = z("lodging_cost") + z("activities_cost")
    total = both + z("transport_cost") + round_half_up(both * other_factor)
    margin, status = budget_margin("budget", total)
    return j.select("plan_id", round_half_up(total).alias("total"), margin.alias("margin"), F.when(total > 0, status).alias("margin_status"))


def budget_margin(budget: ColumnOrName, total: ColumnOrName) -> tuple[Column, Column]:
    """P10: margin = budget - total, and 'within' / 'over'."""
    m = round_half_up(col(budget) - col(total))
    return m, F.when(m >= 0, F.lit("within")).otherwise(F.lit("over"))


# Itinerary texts.
MEALS_TEXT = "Desayuno + almuerzo + cena"
ACTIVITY_TEXT = "actividad"
FIRST_DAY_TEXT = "llegada / paseo inicial"
LAST_DAY_TEXT = "cierre del viaje / paseo libre"
FREE_DAY_TEXT = "tiempo libre"


def itinerary(summary: DataFrame, prefs: DataFrame) -> DataFrame:
    """One row per trip day. Activities are the preferred categories
    repeated by quantity, in category order, one per day; days beyond them
    get the first-day, last-day or free-day default.

    Each preference covers the day positions [cum - quantity, cum) of the
    running total of quantities in category order (a window over one plan's
    few preferences); day rows join their preference on ``plan_id`` with that
    range, so no per-plan list is materialised."""
    from pyspark.sql import Window
    w = Window.partitionBy("plan_id").orderBy("category").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranges = (prefs.select("plan_id", "category", F.col("quantity").cast("long").alias("q"))
              .withColumn("__end", F.sum("q").over(w)).withColumn("__start", F.col("__end") - F.col("q"))
              .select(F.col("plan_id").alias("__pid"), F.col("category").alias("__cat"), "__start", "__end"))
    days = summary.select("plan_id", "start_date", "trip_days",
                          F.explode(F.sequence(F.lit(0), F.col("trip_days") - 1)).alias("__i"))
    j = days.join(ranges, (days.plan_id == ranges.__pid) & (days.__i >= ranges.__start) & (days.__i < ranges.__end), "left")
    txt = (F.when(F.col("__cat").isNotNull(), F.concat(F.lit(f"{MEALS_TEXT} + {ACTIVITY_TEXT} "), F.col("__cat")))
           .when(F.col("__i") == 0, F.lit(f"{MEALS_TEXT} + {FIRST_DAY_TEXT}"))
           .when(F.col("__i") == F.col("trip_days") - 1, F.lit(f"{MEALS_TEXT} + {LAST_DAY_TEXT}"))
           .otherwise(F.lit(f"{MEALS_TEXT} + {FREE_DAY_TEXT}")))
    return j.select("plan_id", (F.col("__i") + 1).alias("day_no"),
                    F.date_add("start_date", F.col("__i")).alias("day_date"), txt.alias("suggestion"))


# The packing checklist. (section, item, quantity rule);
# the rule names one of the quantity formulas below, None = no quantity.
CHECKLIST_ITEMS: tuple[tuple[str, str, str | None], ...] = (
    ("Importante", "Pasaporte / documento de identidad", None),
    ("Importante", "Documentos de viaje (reservas / actividades)", None),
    ("Importante", "Dinero", None),
    ("Importante", "Billetera", None),
    ("Importante", "Licencia de conducir", None),
    ("Importante", "Seguro de viaje", None),
    ("Importante", "Copia de seguro", None),
    ("Importante", "Copia de pasaporte", None),
    ("Importante", "Copia de cédula", None),
    ("Importante", "Notificar salida del país al banco", None),
    ("Importante", "Tarjeta de crédito / débito", None),
    ("Importante", "Confirmación de vuelo", None),
    ("Tecnología", "Celular", None),
    ("Tecnología", "Cámara", None),
    ("Tecnología", "Cargador", None),
    ("Tecnología", "Powerbank / cargador portátil", None),
    ("Tecnología", "Audífonos", None),
    ("Tecnología", "Cargador de cámara", None),
    ("Tecnología", "Roaming / eSIM", None),
    ("Higiene", "Cepillo dental y pasta dental", None),
    ("Higiene", "Cepillo para el cabello", None),
    ("Higiene", "Accesorios para el cabello", None),
    ("Higiene", "Shampoo / acondicionador", None),
    ("Higiene", "Jabón corporal", None),
    ("Higiene", "Crema corporal", None),
    ("Higiene", "Repelente", None),
    ("Higiene", "Bloqueador solar", None),
    ("Higiene", "Desodorante", None),
    ("Higiene", "Perfume", None),
    ("Higiene", "Alcohol en gel", None),
    ("Higiene", "Bolsa de maquillaje", None),
    ("Higiene", "Skincare", None),
    ("Higiene", "Medicamentos", None),
    ("Ropa para el viaje", "Vestimenta Completa", "light_clothes"),
    ("Ropa para el viaje", "Sueter", "one"),
    ("Ropa para el viaje", "Sandalias", "one"),
    ("Ropa para el viaje", "Ropa de playa", "one"),
    ("Ropa para el viaje", "Ropa interior", "underwear"),
    ("Ropa para el viaje", "Pijama", "one"),
    ("Ropa para el viaje", "Medias", "socks"),
    ("Ropa para el viaje", "Tenis", "one"),
    ("Ropa para el viaje", "Zapatos", "one"),
    ("Accesorios", "Bolso", None),
    ("Accesorios", "Anteojos de sol", None),
    ("Accesorios", "Bisutería", None),
    ("Accesorios", "Reloj", None),
    ("Otros", "Libro", None),
    ("Otros", "Snacks", None),
    ("Otros", "Botella para agua", None),
    ("Otros", "Toalla de playa", None),
)
EXTRAS_SECTION = "Extras recomendados"
# Fixed values: (keyword in the plan's category text, extra items).
CHECKLIST_EXTRAS: tuple[tuple[str, tuple[str, ...]], ...] = (
    ("cultura", ("Libreta para apuntes o recuerdos", "Calzado cómodo para caminatas urbanas",
                 "Espacio libre en celular o cámara")),
    ("naturaleza", ("Chaqueta ligera", "Ropa deportiva", "Botella extra de agua")),
    ("gastronom", ("Presupuesto extra para comidas", "Ropa casual para restaurantes")),
)
LONG_TRIP_DAYS = 7
LONG_TRIP_EXTRAS = ("Recambio adicional de ropa", "Bolsa para ropa sucia")
NO_EXTRAS_ITEM = "Sin recomendaciones adicionales por ahora"


def _quantity(rule: str | None, days: Column) -> Column:
    if rule is None:
        return F.lit(None).cast("int")
    if rule == "one":
        return F.lit(1)
    if rule == "light_clothes":
        return F.greatest(F.bround(days * 0.5, 0).cast("int"), F.lit(2))
    if rule == "underwear":
        return (days + 1).cast("int")
    if rule == "socks":
        return F.greatest(days - 1, F.lit(1)).cast("int")
    raise ValueError(rule)


def checklist(summary: DataFrame, categories_col: str = "activity_categories") -> DataFrame:
    """The packing list per plan: the fixed sections with quantities
    from the trip length, plus extras by category keyword and for long
    trips (or a placeholder when no extra applies). Built as an array per
    plan and exploded, so it is one narrow pass over the plans."""
    days = F.col("trip_days")
    base = [F.struct(F.lit(i + 1).alias("item_pos"), F.lit(s).alias("section"), F.lit(it).alias("item"),
                     _quantity(q, days).alias("quantity"))
            for i, (s, it, q) in enumerate(CHECKLIST_ITEMS)]
    cats = F.lower(F.coalesce(F.col(categories_col), F.lit("")))
    pos = len(CHECKLIST_ITEMS)
    extras = []
    for kw, items in CHECKLIST_EXTRAS:
        for it in items:
            pos += 1
            extras.append(F.when(cats.contains(kw), F.struct(F.lit(pos).alias("item_pos"), F.lit(EXTRAS_SECTION).alias("section"),
                                                               F.lit(it).alias("item"), F.lit(None).cast("int").alias("quantity"))))
    for it in LONG_TRIP_EXTRAS:
        pos += 1
        extras.append(F.when(days >= LONG_TRIP_DAYS, F.struct(F.lit(pos).alias("item_pos"), F.lit(EXTRAS_SECTION).alias("section"),
                                                                F.lit(it).alias("item"), F.lit(None).cast("int").alias("quantity"))))
    ex = F.filter(F.array(*extras), lambda x: x.isNotNull())
    placeholder = F.array(F.struct(F.lit(pos + 1).alias("item_pos"), F.lit(EXTRAS_SECTION).alias("section"),
                                   F.lit(NO_EXTRAS_ITEM).alias("item"), F.lit(None).cast("int").alias("quantity")))
    all_items = F.concat(F.array(*base), F.when(F.size(ex) > 0, ex).otherwise(placeholder))
    return summary.select("plan_id", F.explode(all_items).alias("it")).select("plan_id", "it.*")


def checklist_progress(state: DataFrame, estimate: DataFrame | None = None) -> DataFrame:
    """Items, completed, % done and the progress message; with the
    estimate (carrying the budget), also the final plan status."""
    p = state.groupBy("plan_id").agg(F.count(F.lit(1)).alias("n_items"),
                                     F.count_if(F.col("done")).alias("n_done"))
    pct_done = F.when(F.col("n_items") > 0, round_half_up(safe_div("n_done", "n_items") * 100)).otherwise(F.lit(0.0))
    p = p.withColumn("progress_pct", pct_done).withColumn(
        "progress_status", F.when(F.col("progress_pct") == 100, "complete")
        .when(F.col("progress_pct") >= 50, "advanced").otherwise("pending"))
    if estimate is not None:
        j = p.join(estimate.select("plan_id", "total_cost", "budget"), "plan_id", "left")
        diff = F.col("budget") - F.col("total_cost")
        p = j.withColumn("final_status",
                         F.when((F.col("total_cost") > 0) & (diff >= 0) & (F.col("progress_pct") >= 50), "solid")
                         .when((F.col("total_cost") > 0) & (diff < 0), "review_budget")
                         .otherwise("incomplete")).drop("budget", "total_cost")
    return p


def insert_new(existing: DataFrame, incoming: DataFrame, natural_key: Sequence[str],
               order: Sequence[ColumnOrName]) -> DataFrame:
    """Insert-unless-exists: in-batch duplicates collapse to the first
    (K1), keys already present are skipped (anti join); returns the rows to
    append."""
    batch = keep_first_per_key(incoming, natural_key, order)
    return batch.join(existing.select(*natural_key).distinct(), list(natural_key), "left_anti")


def upsert(existing: DataFrame, incoming: DataFrame, keys: Sequence[str], version: str) -> DataFrame:
    """Last value wins per key across the table and the batch."""
    return keep_last_per_key(existing.unionByName(incoming, allowMissingColumns=True), keys, [version])


def append_validated(entries: DataFrame, plan_col: str = "plan_id", amount_col: str = "amount") -> tuple[DataFrame, DataFrame]:
    """Split ledger entries into (valid, rejected): plan not null and
    amount >= 0."""
    rules = {"plan_not_null": F.col(plan_col).isNotNull(), "amount_non_negative": F.col(amount_col) >= 0}
    return split_valid(entries, rules)


def cascade_keep(children: DataFrame, parents: DataFrame, key: str = "plan_id") -> DataFrame:
    """Children whose parent survives (semi join): the cascade delete."""
    return children.join(parents.select(key).distinct(), key, "left_semi")


def plan_rule_violations(plans: DataFrame) -> DataFrame:
    """Required fields and date order."""
    rules = {
        "user_required": F.col("user_id").isNotNull(),
        "origin_required": F.col("origin_country_id").isNotNull(),
        "destination_required": F.col("dest_country_id").isNotNull(),
        "dates_required": F.col("start_date").isNotNull() & F.col("end_date").isNotNull(),
        "end_not_before_start": F.col("end_date") >= F.col("start_date"),
        "budget_non_negative": F.col("budget") >= 0,
    }
    return rule_violations(plans, rules, ["plan_id"])
