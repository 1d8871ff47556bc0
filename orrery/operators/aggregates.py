"""Aggregations A1-A27.

All of them are ``groupBy().agg`` (partial aggregation on the map side, so
a hot key is combined before the shuffle). Global statistics are one-row
aggregates that callers join back with a broadcast cross join, never an
unpartitioned window.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.common import ColumnOrName, col, pct, round_half_up, safe_div
from .joins import attach_scalars, null_safe_join
from .quantiles import quantiles, with_quantiles


def drop_null_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """pandas ``groupby`` drops null keys; SQL keeps them (§7.5 item 3)."""
    return df.dropna(subset=list(keys)) if keys else df


def group_means(df: DataFrame, keys: Sequence[str], columns: Mapping[str, str] | Sequence[str],
                scale: int | None = 2, drop_nulls: bool = True) -> DataFrame:
    """A1: rounded group means with named outputs ({out_name: column})."""
    named = dict(columns) if isinstance(columns, Mapping) else {c: c for c in columns}
    src = drop_null_keys(df, keys) if drop_nulls else df
    aggs = [(round_half_up(F.avg(c), scale) if scale is not None else F.avg(c)).alias(out)
            for out, c in named.items()]
    return src.groupBy(*keys).agg(*aggs)


def frequency(df: DataFrame, keys: str | Sequence[str], count_col: str = "n",
              share_col: str | None = "share_pct", scale: int = 2) -> DataFrame:
    """A2: counts per label with the share of the total (a one-row total
    broadcast back, not an unpartitioned window)."""
    ks = [keys] if isinstance(keys, str) else list(keys)
    counts = df.groupBy(*ks).agg(F.count(F.lit(1)).alias(count_col))
    if not share_col:
        return counts
    return (attach_scalars(counts, counts.agg(F.sum(count_col).alias("__total")))
            .withColumn(share_col, round_half_up(pct(count_col, "__total"), scale)).drop("__total"))


def global_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """A3: one row with the row count of each table (one-row aggregates
    cross-joined)."""
    items = list(tables.items())
    first_name, first = items[0]
    base = first.agg(F.count(F.lit(1)).alias(first_name))
    return attach_scalars(base, *[df.agg(F.count(F.lit(1)).alias(name)) for name, df in items[1:]])


def table_counts(tables: Mapping[str, DataFrame], name_col: str = "table_name",
                 count_col: str = "n_rows") -> DataFrame:
    """Row counts per table as rows (UNION ALL)."""
    parts = [df.agg(F.count(F.lit(1)).alias(count_col)).select(F.lit(n).alias(name_col), count_col)
             for n, df in tables.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def count_by(df: DataFrame, keys: str | Sequence[str], count_col: str = "n") -> DataFrame:
    """A5: rows per key."""
    ks = [keys] if isinstance(keys, str) else list(keys)
    return df.groupBy(*ks).agg(F.count(F.lit(1)).alias(count_col))


def coverage(df: DataFrame, keys: Sequence[str], present: ColumnOrName, total_col: str = "total",
             with_col: str = "with_match", without_col: str = "without_match",
             pct_col: str = "coverage_pct", scale: int = 2) -> DataFrame:
    """Conditional counts and a coverage percentage with safe division."""
    p = col(present)
    return df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias(total_col),
        F.sum(F.when(p, 1).otherwise(0)).alias(with_col),
        F.sum(F.when(p, 0).otherwise(1)).alias(without_col),
    ).withColumn(pct_col, round_half_up(pct(with_col, total_col), scale))


def split_counts(df: DataFrame, keys: Sequence[str], condition: Column, total_col: str = "n_total",
                 true_col: str = "n_true", false_col: str = "n_false") -> DataFrame:
    """``COUNT(*) FILTER`` split of each group."""
    return df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias(total_col),
        F.count_if(condition).alias(true_col),
        F.count_if(~condition).alias(false_col),
    )


def summary_per_key(df: DataFrame, keys: Sequence[str], means: Mapping[str, ColumnOrName],
                    count_col: str = "n_rows", scale: int = 2) -> DataFrame:
    """Count plus rounded averages of columns or row expressions
    (``avg((a + b) / 2)`` is null for a row where either is null)."""
    return df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias(count_col),
        *[round_half_up(F.avg(col(c)), scale).alias(out) for out, c in means.items()],
    )


def two_level_rollup(df: DataFrame, parent: str, child: str, sums: Sequence[str], means: Sequence[str],
                     scale: int = 2, level_col: str = "level") -> DataFrame:
    """The same metrics at (parent, child) and (parent) level in one
    pass with ``rollup``; the grand total row is dropped."""
    aggs = ([round_half_up(F.sum(c), scale).alias(f"sum_{c}") for c in sums]
            + [round_half_up(F.avg(c), scale).alias(f"avg_{c}") for c in means])
    r = df.rollup(parent, child).agg(F.grouping_id().alias("__g"), *aggs)
    r = r.filter(F.col("__g") < 3)
    return r.withColumn(level_col, F.when(F.col("__g") == 0, F.lit(child)).otherwise(F.lit(parent))).drop("__g")


def distinct_counts(df: DataFrame, keys: Sequence[str], columns: Mapping[str, str]) -> DataFrame:
    """Exact distinct counts per group ({out_name: column})."""
    return df.groupBy(*keys).agg(*[F.countDistinct(c).alias(o) for o, c in columns.items()])


def ordered_string_agg(df: DataFrame, keys: Sequence[str], label: str, count: str,
                       out: str = "labels", sep: str = ", ") -> DataFrame:
    """``label (n), label (n)`` ordered by label (``listagg ... WITHIN
    GROUP``). Meant for small groups such as the categories of one plan."""
    item = f"concat(`{label}`, ' (', cast(`{count}` as string), ')')"
    sep_sql = sep.replace("'", "''")
    agg = F.expr(f"listagg({item}, '{sep_sql}') WITHIN GROUP (ORDER BY `{label}`)")
    return df.groupBy(*keys).agg(agg.alias(out))


def group_mode(df: DataFrame, keys: Sequence[str], column: str, out: str | None = None) -> DataFrame:
    """Most frequent value, ties to the smallest, null if the group
    has no value. Two aggregates (count per value, then ``min_by`` over
    (-count, value) per group), so no task holds a whole group's values."""
    counts = df.filter(F.col(column).isNotNull()).groupBy(*keys, column).agg(F.count(F.lit(1)).alias("__c"))
    best = counts.groupBy(*keys).agg(
        F.min_by(F.col(column), F.struct((-F.col("__c")).alias("a"), F.col(column).alias("b"))).alias(out or f"mode_{column}"))
    groups = df.select(*keys).distinct()
    return null_safe_join(groups, best, keys) if keys else best


def first_by_order(df: DataFrame, keys: Sequence[str], value: str, order: Sequence[ColumnOrName],
                   out: str | None = None) -> DataFrame:
    """First value per group in a stable order (``min_by`` on a struct)."""
    o = F.struct(*[col(c) for c in order])
    return df.groupBy(*keys).agg(F.min_by(F.col(value), o).alias(out or f"first_{value}"))


def group_quantiles(df: DataFrame, keys: Sequence[str], column: str, probs: Mapping[str, float],
                    scale: int | None = 2, method: str = "exact", accuracy: int = 10000) -> DataFrame:
    """Exact (linear interpolation) quantiles per group, one named
    column each. ``method='exact'`` (default) is skew-safe;
    'map' uses Spark's ``percentile``; 'approx' uses ``percentile_approx``."""
    return quantiles(df, column, probs, keys, method=method, scale=scale, accuracy=accuracy)


def global_quantiles(df: DataFrame, column: str, probs: Sequence[float], scale: int | None = 2,
                     prob_col: str = "prob", value_col: str = "value") -> DataFrame:
    """Quantile table (one row per probability)."""
    named = {f"__q{i}": float(p) for i, p in enumerate(probs)}
    one = quantiles(df, column, named, scale=scale)
    rows = [F.struct(F.lit(p).alias(prob_col), F.col(n).alias(value_col)) for n, p in named.items()]
    return one.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def two_stage_median(df: DataFrame, inner_keys: Sequence[str], outer_keys: Sequence[str], column: str,
                     out: str = "median_of_medians", scale: int = 2) -> DataFrame:
    """Median per inner group, then the median of those per outer group."""
    inner = quantiles(df, column, {"__m": 0.5}, inner_keys)
    return quantiles(inner, "__m", {out: 0.5}, outer_keys, scale=scale)


def numeric_profile(df: DataFrame, column: str, keys: Sequence[str] = (), scale: int = 2) -> DataFrame:
    """Count, mean, std, min, quartiles, max (exact quartiles)."""
    c = F.col(column)
    aggs = [
        F.count(c).alias("count"),
        round_half_up(F.avg(c), scale).alias("mean"),
        round_half_up(F.stddev_samp(c), scale).alias("std"),
        round_half_up(F.min(c), scale).alias("min"),
        round_half_up(F.max(c), scale).alias("max"),
    ]
    base = df.groupBy(*keys).agg(*aggs) if keys else df.agg(*aggs)
    out = with_quantiles(base, df, column, {"p25": 0.25, "p50": 0.5, "p75": 0.75}, keys, scale)
    return out.select(*keys, "count", "mean", "std", "min", "p25", "p50", "p75", "max")


def correlation(df: DataFrame, x: str, y: str, keys: Sequence[str] = (), out: str = "pearson_r",
                scale: int = 4) -> DataFrame:
    """Pearson r on pairwise non-null rows (global or per group)."""
    pair = df.filter(F.col(x).isNotNull() & F.col(y).isNotNull())
    agg = round_half_up(F.corr(x, y), scale).alias(out)
    return pair.groupBy(*keys).agg(agg) if keys else pair.agg(agg)


def correlation_matrix(df: DataFrame, columns: Sequence[str], scale: int = 4) -> DataFrame:
    """All pairs in one aggregate, returned long (x, y, r). Each pair
    uses its own pairwise non-null rows."""
    aggs = []
    for a in columns:
        for b in columns:
            both = F.col(a).isNotNull() & F.col(b).isNotNull()
            aggs.append(round_half_up(F.corr(F.when(both, F.col(a)), F.when(both, F.col(b))), scale).alias(f"{a}__{b}"))
    wide = df.agg(*aggs)
    stack = ", ".join(f"'{a}', '{b}', `{a}__{b}`" for a in columns for b in columns)
    return wide.selectExpr(f"stack({len(columns) ** 2}, {stack}) as (x, y, r)")


def share_true(df: DataFrame, condition: Column, keys: Sequence[str] = (), out: str = "share_pct",
               scale: int = 2) -> DataFrame:
    """Percentage of rows meeting a condition; a null comparison counts
    as false in the denominator (pandas)."""
    agg = round_half_up(F.avg(F.coalesce(condition, F.lit(False)).cast("int")) * 100, scale).alias(out)
    return df.groupBy(*keys).agg(agg) if keys else df.agg(agg)


def period_rollup(df: DataFrame, keys: Sequence[str], ts: ColumnOrName, fmt: str = "yyyy-MM",
                  means: Sequence[str] = (), sums: Sequence[str] = (), period_col: str = "period",
                  scale: int = 2) -> DataFrame:
    """Daily series to a period (month by default): means and totals."""
    return df.groupBy(*keys, F.date_format(col(ts), fmt).alias(period_col)).agg(
        *[round_half_up(F.avg(c), scale).alias(f"avg_{c}") for c in means],
        *[round_half_up(F.sum(c), scale).alias(f"sum_{c}") for c in sums],
    )


def group_size_profile(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows per composite key, then the numeric profile of those sizes."""
    sizes = df.groupBy(*keys).agg(F.count(F.lit(1)).cast("double").alias("group_size"))
    return numeric_profile(sizes, "group_size")


def scenario_compare(df: DataFrame, scenarios: Mapping[str, Column], metrics: Mapping[str, ColumnOrName],
                     scale: int = 2) -> DataFrame:
    """Metrics (means) under several row filters in one pass, returned
    one row per scenario in the given order (``scenario_pos``)."""
    aggs = []
    for s, cond in scenarios.items():
        aggs.append(F.count_if(cond).alias(f"{s}__n_rows"))
        for m, c in metrics.items():
            aggs.append(round_half_up(F.avg(F.when(cond, col(c))), scale).alias(f"{s}__{m}"))
    wide = df.agg(*aggs)
    rows = []
    for i, s in enumerate(scenarios):
        rows.append(F.struct(F.lit(i + 1).alias("scenario_pos"), F.lit(s).alias("scenario"),
                             F.col(f"{s}__n_rows").alias("n_rows"),
                             *[F.col(f"{s}__{m}").alias(m) for m in metrics]))
    return wide.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def totals_per_key(df: DataFrame, keys: Sequence[str], amount: str, total_col: str = "total",
                   count_col: str = "n", scale: int = 2) -> DataFrame:
    """Ledger totals and entry counts."""
    return df.groupBy(*keys).agg(round_half_up(F.sum(amount), scale).alias(total_col),
                                 F.count(F.lit(1)).alias(count_col))


def null_share(df: DataFrame, keys: Sequence[str], column: str, out: str | None = None,
               scale: int = 2) -> DataFrame:
    """Percentage of null values per group."""
    return df.groupBy(*keys).agg(
        round_half_up(F.avg(F.col(column).isNull().cast("int")) * 100, scale).alias(out or f"null_pct_{column}"))
