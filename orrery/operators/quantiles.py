"""Exact quantiles (linear interpolation, as pandas / ``quantile_cont``)
computed without holding a group's rows in one task.

1. Count the distinct values of every group (combined on the map side, so a
   value or group that holds a third of the rows is one row a task).
2. Cut the number line into buckets by the leading bits of a double, a pure
   function of the value. Counts by bucket are small; a running sum over them
   says which bucket holds each wanted rank. A bucket's row carries its ranks
   on, so the next level is one join, one aggregate and one window, all on the
   same key.
3. Only the wanted buckets go on: once more by further bits, then by value.

No result depends on partitions, samples or the reuse of an exchange. Several
value columns share all steps, and so do the groups and all rows together.

``method='map'``: Spark's ``percentile``; ``method='approx'``:
``percentile_approx`` (bounded memory, approximate).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.common import round_half_up

_FINE_BITS = 28
_COARSE_SHIFT = 16  # the coarse bucket has 12 bits of each binade


def _bucket(v: Column) -> Column:
    """A rising function of a double: its binade and ``_FINE_BITS`` bits more."""
    a = F.abs(v)
    e = F.floor(F.log2(a))
    fraction = F.floor(a / F.pow(F.lit(2.0), e) * float(1 << _FINE_BITS)) - (1 << _FINE_BITS)
    size = (e + 1100) * (1 << _FINE_BITS) + fraction
    big = F.lit(1 << 60)
    size = F.when(a == float("inf"), big).when(a == 0, F.lit(0).cast("long")).otherwise(size)
    return F.when(F.isnan(v), big + 1).when(v < 0, -size).otherwise(size)


def quantiles_of(df: DataFrame, specs: Mapping[str, tuple[str | Column, float]], keys: Sequence[str] = (),
                 scale: int | None = None, overall: str | None = None) -> DataFrame:
    """One row per group (or one row) with a column per name of ``specs``
    ({name: (value column, probability)}). Null values do not count; a group
    without values of any of the columns has no row. With ``overall`` (and
    keys) one more row has the quantiles of all rows: its keys are null, and
    the column of that name tells it from the groups."""
    keys = list(keys)
    columns: list = []
    wanted: list[tuple[int, float]] = []
    for value, p in specs.values():
        at = next((i for i, c in enumerate(columns) if c is value or isinstance(value, str) and c == value), None)
        if at is None:
            columns.append(value)
            at = len(columns) - 1
        wanted.append((at, float(p)))
    # The group and the value column as one struct: never null itself, so joins
    # on it are plain equalities that keep null keys together, and one hash
    # partitioning serves the join, the aggregate and the window of a level.
    kc = [f"k{i}" for i in range(len(keys))]
    group = F.struct(*[F.col(k).alias(c) for k, c in zip(keys, kc)], F.lit(False).alias("total"), F.col("__p.c").alias("c"))
    pairs = F.explode(F.array(*[F.struct(F.lit(i).alias("c"), (F.col(v) if isinstance(v, str) else v).cast("double").alias("v"))
                                for i, v in enumerate(columns)]))
    long = df.select(*dict.fromkeys(keys), pairs.alias("__p")).filter(F.col("__p.v").isNotNull())
    counts = long.select(group.alias("__g"), F.col("__p.v").alias("__v")).groupBy("__g", "__v").agg(F.count(F.lit(1)).alias("__n"))
    if overall:
        # The counts of all rows are the sums of the groups' counts.
        whole = F.struct(*[F.lit(None).cast(df.schema[k].dataType).alias(c) for k, c in zip(keys, kc)], F.lit(True).alias("total"), F.col("__g.c").alias("c"))
        counts = counts.unionByName(counts.groupBy(whole.alias("__g"), "__v").agg(F.sum("__n").alias("__n")))
    counts = counts.withColumn("__fine", _bucket(F.col("__v"))).withColumn("__coarse", F.shiftright("__fine", _COARSE_SHIFT))

    def running(table: DataFrame, inside: str, by: str) -> DataFrame:
        """Adds __from: how many values of the bucket ``inside`` stand before."""
        w = Window.partitionBy(inside).orderBy(by).rowsBetween(Window.unboundedPreceding, -1)
        return table.withColumn("__from", F.coalesce(F.sum("__n").over(w), F.lit(0)))

    def held(asks) -> Column:
        """The asked ranks that fall on this row, counted from its start."""
        mine = F.filter(asks, lambda x: (x["rank"] >= F.col("__from")) & (x["rank"] < F.col("__from") + F.col("__n")))
        return F.transform(mine, lambda x: F.struct(x["q"].alias("q"), x["side"].alias("side"), x["frac"].alias("frac"),
                                                    (x["rank"] - F.col("__from")).alias("rank")))

    # Coarse buckets, and in each the ranks (both sides of every probability) that it holds.
    coarse = running(counts.groupBy("__g", "__coarse").agg(F.sum("__n").alias("__n")), "__g", "__coarse")
    coarse = coarse.withColumn("__all", F.sum("__n").over(Window.partitionBy("__g")))
    of_column = F.filter(F.array(*[F.struct(F.lit(i).alias("q"), F.lit(c).alias("c"), F.lit(p).alias("p"), F.lit(side).alias("side"))
                                   for i, (c, p) in enumerate(wanted) for side in (0, 1)]), lambda x: x["c"] == F.col("__g.c"))

    def ask(x: Column) -> Column:
        pos = x["p"] * (F.col("__all") - 1)
        rank = F.when(x["side"] == 0, F.floor(pos)).otherwise(F.ceil(pos))
        return F.struct(x["q"].alias("q"), x["side"].alias("side"), (pos - F.floor(pos)).alias("frac"), rank.cast("long").alias("rank"))

    asked = coarse.select("__g", F.col("__coarse").alias("__at"), held(F.transform(of_column, ask)).alias("__asks"))
    # The fine buckets of the wanted coarse ones, then the values of the wanted fine ones.
    for at, by in (("__coarse", "__fine"), ("__fine", "__v")):
        wants = asked.filter(F.size("__asks") > 0).select(F.struct("__g", "__at").alias("__w"), "__asks")
        part = counts.select(F.struct("__g", F.col(at).alias("__at")).alias("__b"), by, "__n")
        # Without keys there are two wanted buckets a spec at most: broadcast, the counts stay
        # where they are. With keys they grow with the groups: hashed, the counts need no sort.
        wants = wants.hint("shuffle_hash") if keys else F.broadcast(wants)
        part = part.join(wants, F.col("__b") == F.col("__w")).groupBy("__b", by).agg(F.sum("__n").alias("__n"), F.first("__asks").alias("__asks"))
        asked = running(part, "__b", by).select(F.col("__b.__g").alias("__g"), F.col(by).alias("__at"), held(F.col("__asks")).alias("__asks"))
    ranks = asked.select("__g", F.col("__at").alias("__v"), F.explode("__asks").alias("__a"))
    aggs = []
    for i, name in enumerate(specs):
        side = lambda s: F.max(F.when((F.col("__a.q") == i) & (F.col("__a.side") == s), F.col("__v")))  # noqa: E731, B023
        low, high, share = side(0), side(1), F.max(F.when(F.col("__a.q") == i, F.col("__a.frac")))
        val = F.when(low == high, low).otherwise(low + share * (high - low))
        aggs.append((round_half_up(val, scale) if scale is not None else val).alias(name))
    if not keys:
        # A global quantile is one row even on empty input, like an aggregate.
        return ranks.agg(*aggs)
    out = ranks.groupBy(*[F.col(f"__g.{c}").alias(c) for c in kc], F.col("__g.total").alias("__total")).agg(*aggs)
    return out.select(*[F.col(c).alias(k) for c, k in zip(kc, keys)], *([F.col("__total").alias(overall)] if overall else []), *specs)


def quantiles(df: DataFrame, value: str | Column, probs: Mapping[str, float], keys: Sequence[str] = (),
              method: str = "exact", scale: int | None = None, accuracy: int = 10000) -> DataFrame:
    """One row per group (or one row) with a column per named probability."""
    if method == "exact":
        return quantiles_of(df, {name: (value, p) for name, p in probs.items()}, keys, scale)
    if method not in ("map", "approx"):
        raise ValueError(method)
    v = F.col(value) if isinstance(value, str) else value

    def q(p):
        e = F.percentile_approx(v, p, accuracy) if method == "approx" else F.percentile(v, p)
        return round_half_up(e, scale) if scale is not None else e
    aggs = [q(p).alias(n) for n, p in probs.items()]
    return df.groupBy(*keys).agg(*aggs) if keys else df.agg(*aggs)


def join_keys(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Join two per-group results on their (possibly null) group keys."""
    if not keys:
        from .joins import attach_scalars
        return attach_scalars(left, right)
    r = right.select(*[F.col(k).alias(f"__r_{k}") for k in keys], *[c for c in right.columns if c not in keys])
    cond = None
    for k in keys:
        e = left[k].eqNullSafe(r[f"__r_{k}"])
        cond = e if cond is None else cond & e
    return left.join(r, cond, how).drop(*[f"__r_{k}" for k in keys])


def with_quantiles(agg: DataFrame, df: DataFrame, value: str | Column, probs: Mapping[str, float],
                   keys: Sequence[str] = (), scale: int | None = None, method: str = "exact") -> DataFrame:
    """Attach quantile columns to an aggregate that has one row per group
    (or a single row)."""
    q = quantiles(df, value, probs, keys, method=method, scale=scale)
    return join_keys(agg, q, list(keys), "left")
