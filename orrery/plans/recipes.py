"""Analytic recipes M1-M25: compositions users call by name."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.common import ColumnOrName, col, pct, round_half_up, safe_div
from ..functions.numeric import bins_from_edges, fixed_bins, pct_change, row_mean
from ..operators.aggregates import group_quantiles
from ..operators.joins import attach_scalars, scalars
from ..operators.quantiles import join_keys, quantiles, quantiles_of, with_quantiles
from ..operators.windows import minmax_normalize, winsorized_normalize
from ..session import cut_lineage

# Category text (lower, trimmed) -> cost group, and the
# group of everything else.
COST_GROUP_RULES = {"comida y bebida": "alimentacion", "servicios": "servicios", "otros": "otros"}
COST_GROUP_DEFAULT = "actividades"


def price_by_province(fact: DataFrame, provinces: DataFrame, keys: Sequence[str] = ("country_id", "province_id"),
                      category: str = "category", weekday: str = "weekday_price", weekend: str = "weekend_price",
                      province_name: str = "province_name", scale: int = 2) -> DataFrame:
    """M1: weekday, weekend and mean price per province and category
    (inner join to the province dimension; the mean of (weekday+weekend)/2
    skips rows where either is null)."""
    ks = list(keys)
    dim = provinces.select(ks[-1], province_name)
    j = fact.join(dim, ks[-1], "inner")
    return j.groupBy(*ks, province_name, category).agg(
        round_half_up(F.avg(weekday), scale).alias("avg_weekday"),
        round_half_up(F.avg(weekend), scale).alias("avg_weekend"),
        round_half_up(F.avg((F.col(weekday) + F.col(weekend)) / 2), scale).alias("avg_price"),
    )


def activities_by_province(fact: DataFrame, provinces: DataFrame, keys: Sequence[str] = ("country_id", "province_id"),
                           category: str = "category", price: str = "entry_price", spend: str = "total_spend",
                           province_name: str = "province_name", scale: int = 2) -> DataFrame:
    """M2: rows, mean entry price and mean spend per province and category."""
    ks = list(keys)
    j = fact.join(provinces.select(ks[-1], province_name), ks[-1], "inner")
    return j.groupBy(*ks, province_name, category).agg(
        F.count(F.lit(1)).alias("n_rows"),
        round_half_up(F.avg(price), scale).alias("avg_entry_price"),
        round_half_up(F.avg(spend), scale).alias("avg_spend"),
    )


def cost_group(category: ColumnOrName, rules: Mapping[str, str] = COST_GROUP_RULES,
               default: str = COST_GROUP_DEFAULT) -> Column:
    """CASE on the normalised category text."""
    x = F.lower(F.trim(col(category)))
    expr = None
    for k, v in rules.items():
        expr = F.when(x == k, F.lit(v)) if expr is None else expr.when(x == k, F.lit(v))
    return expr.otherwise(F.lit(default)) if expr is not None else F.lit(default)


def with_cost_group(rec: DataFrame, rules: Mapping[str, str] = COST_GROUP_RULES,
                    default: str = COST_GROUP_DEFAULT, category: str = "category") -> DataFrame:
    """M3: add ``cost_group`` to the M2 result."""
    return rec.withColumn("cost_group", cost_group(category, rules, default))


def quantile_bins(df: DataFrame, value: str, n_bins: int = 4, out: str = "quantile_bin",
                  labels: Sequence[str] | None = None) -> DataFrame:
    """Equal-frequency bins from exact quantile edges (right
    closed, lowest included), not ``ntile`` (which splits ties). The edges
    are one broadcast row."""
    labels = list(labels) if labels else [f"Q{i + 1}" for i in range(n_bins)]
    probs = {f"__e{i}": i / n_bins for i in range(n_bins + 1)}
    j = attach_scalars(df, quantiles(df, value, probs))
    return j.withColumn(out, bins_from_edges(value, [F.col(c) for c in probs], labels)).drop(*probs)


def weekend_premium(fact: DataFrame, weekday: str = "weekday_price", weekend: str = "weekend_price",
                    exclude_flag: str | None = None, scale: int = 2) -> DataFrame:
    """M7: distribution of the weekend premium over rows with both prices:
    shares higher / lower / equal, mean and median premium %. Rows flagged
    ``exclude_flag`` (replicated copies) can be left out."""
    pairs = fact.filter(F.col(weekday).isNotNull() & F.col(weekend).isNotNull())
    if exclude_flag:
        pairs = pairs.filter(~F.coalesce(F.col(exclude_flag), F.lit(False)))
    pairs = pairs.withColumn("__prem", pct_change(weekday, weekend))
    prem = F.col("__prem")
    wd, we = F.col(weekday), F.col(weekend)
    med = quantiles(pairs, "__prem", {"median_premium_pct": 0.5}, scale=scale)
    return pairs.agg(
        F.count(F.lit(1)).alias("n_pairs"),
        round_half_up(F.avg((we > wd).cast("int")) * 100, scale).alias("share_higher_pct"),
        round_half_up(F.avg((we < wd).cast("int")) * 100, scale).alias("share_lower_pct"),
        round_half_up(F.avg((we == wd).cast("int")) * 100, scale).alias("share_equal_pct"),
        round_half_up(F.avg(prem), scale).alias("mean_premium_pct"),
    ).select("*", *[v.alias(k) for k, v in scalars(med).items()])


def monthly_seasonality(fact: DataFrame, month: str, value: str, stat: str = "median",
                        scale: int = 2, lead_time: str | None = None, lead_times: Sequence[str] = ()) -> DataFrame:
    """M8: median (or mean) per month, with peak / low flags and the
    amplitude (months are few: the extremes are one scalar row). With
    ``lead_time`` only rows of the given ``lead_times`` count."""
    if lead_time is not None:
        fact = fact.filter(F.col(lead_time).isin(list(lead_times)))
    if stat == "median":
        m = quantiles(fact, value, {"stat": 0.5}, [month])
    else:
        m = fact.groupBy(month).agg(round_half_up(F.avg(value), 6).alias("stat"))
    j = attach_scalars(m, m.agg(F.max("stat").alias("__hi"), F.min("stat").alias("__lo")))
    return j.select(month, round_half_up("stat", scale).alias(f"{stat}_value"),
                    (F.col("stat") == F.col("__hi")).alias("is_peak"), (F.col("stat") == F.col("__lo")).alias("is_low"),
                    round_half_up(F.col("__hi") - F.col("__lo"), scale).alias("amplitude"))


def category_segmentation(fact: DataFrame, category: str, weekday: str = "weekday_price",
                          weekend: str = "weekend_price", scale: int = 2) -> DataFrame:
    """M9: per category medians of both prices and the premium of the
    weekend median over the weekday median."""
    g = fact.groupBy(category).agg(F.count(F.lit(1)).alias("n_rows"))
    g = join_keys(g, quantiles_of(fact, {"__wd": (weekday, 0.5), "__we": (weekend, 0.5)}, [category]), [category], "left")
    return g.select(category, "n_rows", round_half_up("__wd", scale).alias("median_weekday"),
                    round_half_up("__we", scale).alias("median_weekend"),
                    round_half_up(pct_change("__wd", "__we"), scale).alias("premium_pct"))


def region_ranking(fact: DataFrame, region: str, value: str, scale: int = 2) -> DataFrame:
    """Per region median, p25, p75, IQR and index against the overall
    median (=100), ranked by median (rank computed on the small per-region
    table)."""
    from pyspark.sql import Window
    g = fact.groupBy(region).agg(F.count(F.lit(1)).alias("n_rows"))
    q = quantiles_of(fact, {"__med": (value, 0.5), "__p25": (value, 0.25), "__p75": (value, 0.75)}, [region], overall="__overall")
    # The overall median comes from the same counts; the window runs over one row per region.
    national = F.max(F.when(F.col("__overall"), F.col("__med"))).over(Window.partitionBy(F.lit(0)))
    q = q.withColumn("__nat", national).filter(~F.col("__overall")).drop("__overall")
    j = join_keys(g, q, [region], "left")
    w = Window.orderBy(F.col("__med").asc(), F.col(region).asc())
    return j.select(region, "n_rows", round_half_up("__med", scale).alias("median"),
                    round_half_up("__p25", scale).alias("p25"), round_half_up("__p75", scale).alias("p75"),
                    round_half_up(F.col("__p75") - F.col("__p25"), scale).alias("iqr"),
                    round_half_up(safe_div("__med", "__nat") * 100, scale).alias("index_vs_overall"),
                    F.row_number().over(w).alias("rank_cheapest"))


def price_quality_quartiles(fact: DataFrame, price: str, rating: str, scale: int = 2) -> DataFrame:
    """Price quartile (exact edges) -> rows, median price, median rating.
    Prices and ratings are checkpointed when the plan is built."""
    # Written once: the edges, the medians and the counts read it.
    fact = cut_lineage(fact.select(price, rating).filter(F.col(price).isNotNull()))
    q = quantile_bins(fact, price, 4, "price_quartile")
    g = q.groupBy("price_quartile").agg(F.count(F.lit(1)).alias("n_rows"))
    return join_keys(g, quantiles_of(q, {"median_price": (price, 0.5), "median_rating": (rating, 0.5)}, ["price_quartile"], scale),
                     ["price_quartile"], "left")


def overpriced(fact: DataFrame, price: str, rating: str, n: int, order_tiebreak: Sequence[str]) -> DataFrame:
    """Rows priced at or above the p75 price and rated at or below the
    p25 rating; the n dearest (the top-n is the feature)."""
    j = attach_scalars(fact, quantiles_of(fact, {"__p75": (price, 0.75), "__r25": (rating, 0.25)}))
    j = j.filter((F.col(price) >= F.col("__p75")) & (F.col(rating) <= F.col("__r25")))
    return j.orderBy(F.col(price).desc(), *[F.col(c).asc() for c in order_tiebreak]).limit(n).drop("__p75", "__r25")


def quality_price_score(fact: DataFrame, price: str, rating: str, w_rating: float = 0.6, w_price: float = 0.4,
                        out: str = "qp_score") -> DataFrame:
    """w_rating x rating (min-max) + w_price x (1 - winsorised price)."""
    d = minmax_normalize(fact, rating, "__rn")
    d = winsorized_normalize(d, price, out="__pn")
    return d.withColumn(out, F.lit(w_rating) * F.col("__rn") + F.lit(w_price) * (F.lit(1.0) - F.col("__pn"))).drop("__rn", "__pn")


def price_value_score(fact: DataFrame, group: str, price: str, rating: str, min_rows: int = 100,
                      out: str = "value_score") -> DataFrame:
    """Groups with at least ``min_rows`` rows: median price and mean
    rating, min-max scaled (price inverted), 0.5 / 0.5."""
    g = fact.groupBy(group).agg(F.count(F.lit(1)).alias("n_rows"), F.avg(rating).alias("mean_rating"))
    g = with_quantiles(g.filter(F.col("n_rows") >= min_rows), fact, price, {"median_price": 0.5}, [group])
    g = minmax_normalize(g, "median_price", "__p", invert=True)
    g = minmax_normalize(g, "mean_rating", "__r")
    return g.withColumn(out, 0.5 * F.col("__p") + 0.5 * F.col("__r")).drop("__p", "__r")


def strategic_score(df: DataFrame, price: str, rating: str, location: str, weights=(0.4, 0.4, 0.2),
                    out: str = "strategic_score") -> DataFrame:
    """Weights x (inverted min-max price, min-max rating, location score)."""
    d = minmax_normalize(df, price, "__p", invert=True)
    d = minmax_normalize(d, rating, "__r")
    wp, wr, wl = weights
    return d.withColumn(out, wp * F.col("__p") + wr * F.col("__r") + wl * F.col(location)).drop("__p", "__r")


def potential_saving(fact: DataFrame, keys: Sequence[str], value: str, scale: int = 2) -> DataFrame:
    """(p75 - p25) / p75 per group, in %."""
    g = quantiles(fact, value, {"__p25": 0.25, "__p75": 0.75}, keys)
    return g.select(*keys, round_half_up("__p25", scale).alias("p25"), round_half_up("__p75", scale).alias("p75"),
                    round_half_up(safe_div(F.col("__p75") - F.col("__p25"), "__p75") * 100, scale).alias("saving_pct"))


def rating_confidence(fact: DataFrame, opinions: str, rating: str, edges: Sequence[float], labels: Sequence[str],
                      scale: int = 2) -> DataFrame:
    """Mean rating and rows per opinion-count bin."""
    b = fact.withColumn("opinion_bin", fixed_bins(opinions, edges, labels))
    return b.groupBy("opinion_bin").agg(F.count(F.lit(1)).alias("n_rows"),
                                        round_half_up(F.avg(rating), scale).alias("mean_rating"))


def rating_coverage(fact: DataFrame, rating: str, metrics: Sequence[str], scale: int = 2) -> DataFrame:
    """Rows with / without a rating, their share and the mean of each
    metric in both groups."""
    f = fact.withColumn("has_rating", F.col(rating).isNotNull())
    g = f.groupBy("has_rating").agg(F.count(F.lit(1)).alias("n_rows"),
                                    *[round_half_up(F.avg(m), scale).alias(f"avg_{m}") for m in metrics])
    return attach_scalars(g, g.agg(F.sum("n_rows").alias("__t"))).withColumn("share_pct", round_half_up(pct("n_rows", "__t"), scale)).drop("__t")


def extremes_report(fact: DataFrame, value: str, scale: int = 2) -> DataFrame:
    """p95 and p99 of a value plus how many rows exceed each (the dearest
    rows themselves: ``topk.top_n``)."""
    j = attach_scalars(fact, quantiles(fact, value, {"__p95": 0.95, "__p99": 0.99}))
    return j.agg(round_half_up(F.first("__p95"), scale).alias("p95"), round_half_up(F.first("__p99"), scale).alias("p99"),
                 F.count_if(F.col(value) > F.col("__p95")).alias("n_above_p95"),
                 F.count_if(F.col(value) > F.col("__p99")).alias("n_above_p99"))


def lead_time_mix(fact: DataFrame, month: str, lead_time: str, value: str, scale: int = 2) -> DataFrame:
    """Share of each lead-time bucket in the month's rows and the
    median value per (month, bucket)."""
    from ..operators.windows import share_within
    g = fact.groupBy(month, lead_time).agg(F.count(F.lit(1)).alias("n_rows"))
    g = with_quantiles(g, fact, value, {"median_value": 0.5}, [month, lead_time], scale)
    return share_within(g, [month], "n_rows")


def source_comparison(fact: DataFrame, source: str, flag: str, metrics: Sequence[str], scale: int = 2) -> DataFrame:
    """Rows and mean metrics by source and replicated flag."""
    return fact.groupBy(source, flag).agg(F.count(F.lit(1)).alias("n_rows"),
                                          *[round_half_up(F.avg(m), scale).alias(f"avg_{m}") for m in metrics])


LODGING_KEY = ("country_id", "province_id", "month", "category", "lead_time")


def build_lodging_fact(raw: DataFrame, provinces: DataFrame, ratings: DataFrame, rentals: DataFrame,
                       bridge: DataFrame, rating_divisor: float = 20.0) -> DataFrame:
    """M4: lodging fact from raw text rows.

    ``raw``: (province_text, month, category, lead_text, weekday_text,
    weekend_text) with Spanish-formatted numbers; ``provinces``: (province_id,
    province_name, country_id); ``ratings``: (country_id, province_id, month,
    category, rating_0_100), several rows a key allowed; ``rentals``:
    region-grain rows (country_id, month, category, lead_time, weekday_price,
    weekend_price, rating) kept as they are; ``bridge``: (country_id,
    province_id).

    Steps: parse numbers (N1), normalise lead times and names (S1) and map the
    names to ids (J1), impute both prices by the full key, then place, month
    and category, then country, month and category, then all (W1), aggregate
    to the full key (A1, null keys dropped), join the key's mean rating of the
    month rescaled to 0-5 (J1, N6, F12), expand the region rows to every
    province (J8) as replicated copies with their own category, lead time and
    rating, union (U1) with lineage columns (F11) and number the rows (W10)."""
    from ..functions.numeric import parse_spanish_number
    from ..functions.text import normalize_lead_time, normalize_text
    from ..operators.keys import surrogate_key
    from ..operators.windows import impute_hierarchical
    from ..operators.joins import map_distinct
    r = raw.select("province_text", "month", "category", normalize_lead_time("lead_text").alias("lead_time"),
                   parse_spanish_number("weekday_text").alias("weekday_price"),
                   parse_spanish_number("weekend_text").alias("weekend_price"))
    dim = provinces.select(normalize_text("province_name").alias("province_key"), "province_id", "country_id")
    # Names are few: normalise and map each distinct name once (S1 + J1).
    r = map_distinct(r, "province_text",
                     lambda d: d.withColumn("province_key", normalize_text("__dv")).join(dim, "province_key", "left"),
                     ["province_id", "country_id"]).drop("province_text")
    keys = list(LODGING_KEY)
    levels = [keys, ["country_id", "province_id", "month", "category"], ["country_id", "month", "category"]]
    r = impute_hierarchical(r, ["weekday_price", "weekend_price"], levels)
    g = r.dropna(subset=keys).groupBy(*keys).agg(
        round_half_up(F.avg("weekday_price")).alias("weekday_price"),
        round_half_up(F.avg("weekend_price")).alias("weekend_price"))
    rated = ["country_id", "province_id", "month", "category"]
    rt = ratings.groupBy(*rated).agg(round_half_up(F.avg("rating_0_100") / rating_divisor).alias("rating"))
    hotels = g.join(rt, rated, "left").select("*", F.lit("hotel").alias("source"), F.lit("province").alias("origin_grain"),
                                              F.lit(False).alias("is_replicated"))
    copies = rentals.join(bridge.select("country_id", "province_id").distinct(), "country_id", "left").select(
        *keys, "weekday_price", "weekend_price", "rating", F.lit("rentals").alias("source"),
        F.lit("region").alias("origin_grain"), F.lit(True).alias("is_replicated"))
    u = hotels.select(*copies.columns).unionByName(copies)
    u = u.withColumn("has_rating", F.col("rating").isNotNull()).withColumn("geo_level", F.lit("province"))
    return surrogate_key(u, [*keys, "source"], name="lodging_id")


def build_activity_fact(raw: DataFrame, category_map: Mapping[str, str], ratings: DataFrame,
                        zero_fill_ratings: bool = False) -> DataFrame:
    """M5: activity fact: parse text numbers (N1), mean per natural key
    (A1), map the category through a dictionary keeping unknown ones (J10
    replace mode), join the ratings of (country, province, category): of the
    category, in general, and how many opinions, with a flag for the general
    one (J1, F12); optional zero fill of absent ratings (F13, off by
    default)."""
    from ..functions.numeric import parse_spanish_number
    from ..operators.joins import map_values
    r = raw.select("country_id", "province_id", "month", "category", "product",
                   parse_spanish_number("price_text").alias("entry_price"),
                   parse_spanish_number("spend_text").alias("total_spend"))
    keys = ["country_id", "province_id", "month", "category", "product"]
    g = r.dropna(subset=keys).groupBy(*keys).agg(
        round_half_up(F.avg("total_spend")).alias("total_spend"), round_half_up(F.avg("entry_price")).alias("entry_price"))
    g = map_values(g, "category", dict(category_map), mode="replace")
    rated = ["category_rating", "general_rating", "opinions"]
    j = g.join(ratings.select("country_id", "province_id", "category", *rated), ["country_id", "province_id", "category"], "left")
    j = j.withColumn("has_rating", F.col("general_rating").isNotNull())
    if zero_fill_ratings:
        for c in rated:
            j = j.withColumn(c, F.coalesce(F.col(c), F.lit(0.0)))
    return j


def build_island_tables(rows: DataFrame, members: DataFrame, prefix: str = "ES") -> tuple[DataFrame, DataFrame]:
    """M6, islands: (bridge member - island, island dimension).

    ``rows``: (parent_code, local_code, check_digit, island_code, island_name,
    parent_name), one per member on an island; ``members``: the geographic
    dimension (member_code, partial_code). The island id is parent(2) +
    island(2); a row whose partial code is unknown keeps a null member."""
    from ..functions.text import join_id, zfill
    r = rows.select(F.concat(zfill("parent_code", 2), zfill("local_code", 3), F.col("check_digit").cast("string")).alias("partial_code"),
                    F.concat(zfill("parent_code", 2), zfill("island_code", 2)).alias("island_id"),
                    zfill("parent_code", 2).alias("parent_code"), "island_name", "parent_name")
    j = r.join(members.select("partial_code", "member_code").distinct(), "partial_code", "left")
    bridge = j.select(F.lit(prefix).alias("country_id"), "member_code", "partial_code", "island_id", "island_name",
                      join_id(F.lit(prefix), "island_id").alias("island_gid"),
                      F.when(F.col("member_code").isNotNull(), join_id(F.lit(prefix), "member_code")).alias("member_gid")).distinct()
    islands = r.select(F.lit(prefix).alias("country_id"), "island_id", "island_name", "parent_code", "parent_name",
                       join_id(F.lit(prefix), "island_id").alias("island_gid")).distinct()
    return bridge, islands


def group_summary(fact: DataFrame, keys: Sequence[str], means: Sequence[str], total: str, scale: int = 2) -> DataFrame:
    """Rows, mean metrics and the total of one metric per group."""
    return fact.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows"),
                                   *[round_half_up(F.avg(c), scale).alias(f"avg_{c}") for c in means],
                                   round_half_up(F.sum(total), scale).alias(f"sum_{total}"))


def price_stats(fact: DataFrame, keys: Sequence[str], price: str, scale: int = 2) -> DataFrame:
    """Rows, mean, median, min and max price per group."""
    g = fact.groupBy(*keys).agg(F.count(price).alias("n_trips"), round_half_up(F.avg(price), scale).alias("avg_price"),
                                round_half_up(F.min(price), scale).alias("min_price"), round_half_up(F.max(price), scale).alias("max_price"))
    return with_quantiles(g, fact, price, {"median_price": 0.5}, keys, scale)


def month_extremes(fact: DataFrame, month: str, price: str, n: int = 3, scale: int = 2) -> DataFrame:
    """Mean price by month over all routes, with the ``n`` cheapest and
    dearest months marked (ties to the earlier month). Months are twelve."""
    from pyspark.sql import Window
    m = fact.groupBy(month).agg(round_half_up(F.avg(price), 6).alias("__p"))
    cheap = F.row_number().over(Window.orderBy(F.col("__p").asc(), F.col(month).asc()))
    dear = F.row_number().over(Window.orderBy(F.col("__p").desc(), F.col(month).asc()))
    return m.select(month, round_half_up("__p", scale).alias("avg_price"), (cheap <= n).alias("is_cheapest"), (dear <= n).alias("is_dearest"))


def build_geo_dimension(members: DataFrame, parents: DataFrame, grandparents: DataFrame, prefix: str = "ES") -> DataFrame:
    """M6: member dimension with composite ids: region(2) + province(2) +
    local(3) + check digit(1); partial id without the region; global ids
    ``<prefix>-<code>``; names of both parents (J1); distinct rows (U4).

    ``members``: (member_id, member_name, parent_id, local_code, check_digit);
    ``parents``: (parent_id, parent_name, grandparent_id);
    ``grandparents``: (grandparent_id, grandparent_name)."""
    from ..functions.text import join_id, normalize_text, zfill
    j = members.join(parents, "parent_id", "left").join(grandparents, "grandparent_id", "left")
    code = F.concat(zfill("grandparent_id", 2), zfill("parent_id", 2), zfill("local_code", 3),
                    F.col("check_digit").cast("string"))
    out = j.select("member_id", normalize_text("member_name").alias("member_name"),
                   code.alias("member_code"), F.substring(code, 3, 6).alias("partial_code"),
                   zfill("parent_id", 2).alias("parent_code"), zfill("grandparent_id", 2).alias("grandparent_code"),
                   "parent_name", "grandparent_name",
                   join_id(F.lit(prefix), code).alias("member_gid"),
                   join_id(F.lit(prefix), zfill("parent_id", 2)).alias("parent_gid"))
    return out.distinct()
