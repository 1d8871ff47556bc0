"""Window-style operators W1-W12.

The reference computes these with pandas ``transform`` / ``rank`` /
``shift``. Where a window would put a whole group into one task (a hot key
holding a third of the rows), the operator is written as an aggregate
joined back instead; true windows are kept for ordered, already-aggregated
series (year-over-year, running differences).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.common import ColumnOrName, col, pct, round_half_up, safe_div
from .joins import attach_scalars, null_safe_join


def impute_hierarchical(df: DataFrame, value: str | Sequence[str], levels: Sequence[Sequence[str]],
                        global_fallback: bool = True, out: str | None = None,
                        level_col: str | None = None) -> DataFrame:
    """Fill nulls with the mean of the finest group, then of coarser
    groups, then the global mean. Each level's mean is taken over the values
    already filled at the finer levels (sequential semantics).

    Levels must nest (each level's keys a subset of the previous level's).
    Then the whole cascade runs on the per-group statistics of the finest
    level (sum, count of values, count of rows), not on the rows:

      1. one aggregate of the fact (partial, map-side; a hot key is
         combined before the shuffle),
      2. per level, an aggregate of that small statistics table joined back
         to it updates the filled sums and counts,
      3. one join back on the finest keys (null-safe).

    A row whose key at a level is null gets no fill from that level (pandas
    drops null groups). Existing values are never overwritten
    (``coalesce``). Several value columns share the same passes."""
    values = [value] if isinstance(value, str) else list(value)
    if out is not None and len(values) != 1:
        raise ValueError("out applies to a single value column")
    outs = {v: (out or v) for v in values}
    levels = [list(lv) for lv in levels]
    for finer, coarser in zip(levels, levels[1:]):
        if not set(coarser) <= set(finer):
            raise ValueError("levels must nest: each level a subset of the previous one")
    finest = levels[0]
    aggs = [F.count(F.lit(1)).alias("__n")]
    for j, v in enumerate(values):
        x = F.col(v).cast("double")
        aggs += [F.coalesce(F.sum(x), F.lit(0.0)).alias(f"__fs{j}"), F.count(x).alias(f"__fc{j}")]
    table = df.groupBy(*finest).agg(*aggs)
    fill_cols: dict[int, list[str]] = {j: [] for j in range(len(values))}
    for i, keys in enumerate(levels):
        key_ok = F.lit(True)
        for k in keys:
            key_ok = key_ok & F.col(k).isNotNull()
        if i:  # the finest level's groups are the rows of the table
            sums = table.groupBy(*keys).agg(*[F.sum(f"__f{x}{j}").alias(f"__l{x}{j}") for x in "sc" for j in range(len(values))])
            table = null_safe_join(table, sums, keys)
        for j in range(len(values)):
            total, count = (F.col(f"__{'l' if i else 'f'}{x}{j}") for x in "sc")
            table = table.withColumn(f"__m{i}_{j}", F.when(key_ok, F.try_divide(total, count.cast("double"))))
        table = table.drop(*[f"__l{x}{j}" for x in "sc" for j in range(len(values))])
        for j in range(len(values)):
            gap = F.col("__n") - F.col(f"__fc{j}")
            has_mean = F.col(f"__m{i}_{j}").isNotNull() & (gap > 0)
            table = (table.withColumn(f"__fs{j}", F.when(has_mean, F.col(f"__fs{j}") + gap * F.col(f"__m{i}_{j}"))
                                      .otherwise(F.col(f"__fs{j}")))
                     .withColumn(f"__fc{j}", F.when(has_mean, F.col("__n")).otherwise(F.col(f"__fc{j}"))))
            fill_cols[j].append(f"__m{i}_{j}")
    if global_fallback:
        g = table.agg(*[F.try_divide(F.sum(f"__fs{j}"), F.sum(f"__fc{j}").cast("double")).alias(f"__mg_{j}")
                        for j in range(len(values))])
        table = attach_scalars(table, g)
        for j in range(len(values)):
            fill_cols[j].append(f"__mg_{j}")
    all_fill = [c for j in range(len(values)) for c in fill_cols[j]]
    fills = table.select(*[F.col(k).alias(f"__fk{n}") for n, k in enumerate(finest)], *all_fill)
    cond = None
    for n, k in enumerate(finest):
        c = F.col(k).eqNullSafe(F.col(f"__fk{n}"))
        cond = c if cond is None else cond & c
    joined = df.join(fills, cond, "left")
    replaced = set(outs.values())
    cols = [F.col(c) for c in df.columns if c not in replaced]
    filled = [F.coalesce(F.col(v).cast("double"), *[F.col(c) for c in fill_cols[j]]).alias(outs[v])
              for j, v in enumerate(values)]
    extra = []
    if level_col:
        v0 = values[0]
        lvl_expr = F.when(F.col(v0).isNotNull(), F.lit("observed"))
        for i, c in enumerate(fill_cols[0]):
            name = "global" if c.startswith("__mg") else f"level_{i + 1}"
            lvl_expr = lvl_expr.when(F.col(c).isNotNull(), F.lit(name))
        extra.append(lvl_expr.alias(level_col))
    return joined.select(*cols, *filled, *extra)


def share_within(df: DataFrame, parent: Sequence[str], value: str, out: str = "share_pct",
                 scale: int | None = 2) -> DataFrame:
    """Value / sum(value) of its parent * 100. Written as an
    aggregate joined back (a window would sort each parent in one task)."""
    totals = df.groupBy(*parent).agg(F.sum(value).alias("__tot"))
    j = null_safe_join(df, totals, parent) if parent else attach_scalars(df, totals)
    s = pct(value, "__tot")
    return j.withColumn(out, round_half_up(s, scale) if scale is not None else s).drop("__tot")


def top_per_group(df: DataFrame, keys: Sequence[str], order: Sequence[Column], k: int = 1,
                  rank_col: str | None = None) -> DataFrame:
    """W3 top-k per group (``row_number``, method=first); ``order`` must
    end in a unique tie-break for a deterministic result.

    Catalyst keeps only each task's first k rows of a group before the
    shuffle (a partial window group limit), so a group holding a third of the
    rows is never sorted in one task. For k = 1 prefer
    ``first_row_per_group`` (a plain aggregate)."""
    w = Window.partitionBy(*keys).orderBy(*order)
    out = df.withColumn("__rn", F.row_number().over(w)).filter(F.col("__rn") <= k)
    return out.withColumnRenamed("__rn", rank_col) if rank_col else out.drop("__rn")


def first_row_per_group(df: DataFrame, keys: Sequence[str], sort_key: Sequence[ColumnOrName]) -> DataFrame:
    """W3 / W4 aggregate form for ascending sort keys (negate a numeric key
    for descending): one row per group via ``min_by`` (skew-safe)."""
    row = F.struct(*[F.col(c) for c in df.columns])
    o = F.struct(*[col(c).alias(f"o{i}") for i, c in enumerate(sort_key)])
    return df.groupBy(*[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)]).agg(
        F.min_by(row, o).alias("__r")).select("__r.*")


def extremes(df: DataFrame, label: str, value: str, scale: int = 2) -> DataFrame:
    """The label at the maximum and at the minimum, and the amplitude,
    in one aggregate (ties broken by the smallest label)."""
    v = F.col(value)
    return df.agg(
        F.min_by(F.col(label), F.struct((-v).alias("a"), F.col(label).alias("b"))).alias("peak_label"),
        round_half_up(F.max(v), scale).alias("peak_value"),
        F.min_by(F.col(label), F.struct(v.alias("a"), F.col(label).alias("b"))).alias("low_label"),
        round_half_up(F.min(v), scale).alias("low_value"),
        round_half_up(F.max(v) - F.min(v), scale).alias("amplitude"),
    )


def period_change(df: DataFrame, series: Sequence[str], period: str, value: str,
                  out: str = "pct_change", scale: int = 2) -> DataFrame:
    """Percentage change against the previous period of the same series
    (null for the first period or a zero base). Apply to aggregated series."""
    w = Window.partitionBy(*series).orderBy(period)
    prev = F.lag(value).over(w)
    return df.withColumn(out, round_half_up(F.try_multiply(safe_div(F.col(value) - prev, prev), F.lit(100.0)), scale))


def running_diff(df: DataFrame, order: str, value: str, series: Sequence[str], out: str | None = None) -> DataFrame:
    """Value minus the previous row's value (``diff``) of the same
    series. Meant for aggregated series (scenario rows, yearly totals)."""
    w = Window.partitionBy(*series).orderBy(order)
    return df.withColumn(out or f"diff_{value}", F.col(value) - F.lag(value).over(w))


def minmax_normalize(df: DataFrame, value: str, out: str | None = None, invert: bool = False,
                     constant: str = "null", keys: Sequence[str] = ()) -> DataFrame:
    """(x - min) / (max - min), or 1 - that when ``invert``. A constant
    column gives null (plain formula) or 0 (``constant='zero'``, scaler
    mode). The min/max come from a one-row aggregate broadcast back (or a
    per-group aggregate joined back when ``keys`` are given)."""
    out = out or f"{value}_norm"
    stats = df.groupBy(*keys).agg(F.min(value).alias("__lo"), F.max(value).alias("__hi"))
    j = null_safe_join(df, stats, keys) if keys else attach_scalars(df, stats)
    rng = F.col("__hi") - F.col("__lo")
    scaled = safe_div(F.col(value) - F.col("__lo"), F.when(rng != 0, rng))
    if constant == "zero":
        scaled = F.when((rng == 0) & F.col(value).isNotNull(), F.lit(0.0)).otherwise(scaled)
    if invert:
        scaled = F.lit(1.0) - scaled
    return j.withColumn(out, scaled).drop("__lo", "__hi")


def winsorized_normalize(df: DataFrame, value: str, lower: float = 0.05, upper: float = 0.95,
                         out: str | None = None, invert: bool = False) -> DataFrame:
    """Clip to the [lower, upper] quantiles, then min-max scale to [0,1]
    by those bounds."""
    out = out or f"{value}_wnorm"
    from .quantiles import quantiles
    j = attach_scalars(df, quantiles(df, value, {"__lo": lower, "__hi": upper}))
    clipped = F.least(F.greatest(F.col(value), F.col("__lo")), F.col("__hi"))
    scaled = safe_div(clipped - F.col("__lo"), F.when(F.col("__hi") != F.col("__lo"), F.col("__hi") - F.col("__lo")))
    if invert:
        scaled = F.lit(1.0) - scaled
    return j.withColumn(out, scaled).drop("__lo", "__hi")
