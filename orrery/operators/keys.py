"""Duplicates, set operations and surrogate keys.

"Keep one row per key" is written as an aggregate (``min_by`` / ``max_by``
of the whole row over a struct of the ordering columns), not as a window:
the aggregate combines map-side, so a key that holds a third of all rows
never lands whole in one task. A unique tie-break must be part of the
order for the result to be deterministic.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.common import ColumnOrName, col


def _order_struct(order: Sequence[ColumnOrName]) -> Column:
    return F.struct(*[col(c).alias(f"o{i}") for i, c in enumerate(order)])


def keep_one_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[ColumnOrName],
                     last: bool = False) -> DataFrame:
    """K1 (first) / K3 (``last=True``): one row per key by an explicit order.
    Null keys form one group each, as in a window partition (K4)."""
    cols = df.columns
    row = F.struct(*[F.col(c) for c in cols])
    pick = F.max_by(row, _order_struct(order)) if last else F.min_by(row, _order_struct(order))
    agg = df.groupBy(*[F.col(k).alias(f"__k_{k}") for k in keys]).agg(pick.alias("__row"))
    return agg.select("__row.*")


def keep_first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[ColumnOrName]) -> DataFrame:
    """K1."""
    return keep_one_per_key(df, keys, order, last=False)


def keep_last_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[ColumnOrName]) -> DataFrame:
    """Latest wins."""
    return keep_one_per_key(df, keys, order, last=True)


def keep_flagged_per_key(df: DataFrame, keys: Sequence[str], flag: ColumnOrName,
                         order: Sequence[ColumnOrName]) -> DataFrame:
    """K2: prefer the row whose flag is true, then the given order."""
    pref = F.when(F.coalesce(col(flag).cast("boolean"), F.lit(False)), 0).otherwise(1)
    return keep_one_per_key(df, keys, [pref, *order], last=False)


def sequential_unique(df: DataFrame, key_sets: Sequence[Sequence[str]],
                      order: Sequence[ColumnOrName]) -> DataFrame:
    """K5: unique by the first key set, then by the next one, and so on."""
    out = df
    for keys in key_sets:
        out = keep_first_per_key(out, keys, order)
    return out


def dedupe_rows(df: DataFrame) -> DataFrame:
    """U4: distinct rows."""
    return df.distinct()


def union_aligned(*dfs: DataFrame) -> DataFrame:
    """Union by column name; missing columns become null."""
    out = dfs[0]
    for d in dfs[1:]:
        out = out.unionByName(d, allowMissingColumns=True)
    return out


def key_difference(a: DataFrame, b: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Distinct key values of ``a`` missing from ``b`` (null-safe)."""
    return a.select(*keys).distinct().exceptAll(b.select(*keys).distinct())


def key_intersection(a: DataFrame, b: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Distinct key values present in both."""
    return a.select(*keys).intersect(b.select(*keys))


def surrogate_key(df: DataFrame, order: Sequence[ColumnOrName], name: str = "id",
                  num_partitions: int | None = None) -> DataFrame:
    """1-based position of each row in a total order.

    The rows are range-partitioned and sorted by the order, and written once
    as a reliable checkpoint together with their partition and their place in
    it; both the counts of earlier partitions (one small row per partition,
    broadcast back) and the rows are then read from that one written table.
    Spark removes the checkpoint when nothing refers to it any more
    (``spark.cleaner.referenceTracking.cleanCheckpoints``).

    ``order`` must be unique for the ids to be stable across runs."""
    from ..session import cut_lineage
    order_cols = [col(c) for c in order]
    n = num_partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = cut_lineage(df.repartitionByRange(n, *order_cols).sortWithinPartitions(*order_cols)
                         .withColumn("__pid", F.spark_partition_id())
                         .withColumn("__mono", F.monotonically_increasing_id()))
    counts = ranged.groupBy("__pid").agg(F.count(F.lit(1)).alias("__n"), F.min("__mono").alias("__m0"))
    w = Window.orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.withColumn("__off", F.coalesce(F.sum("__n").over(w), F.lit(0)))
    out = ranged.join(F.broadcast(offsets.select("__pid", "__off", "__m0")), "__pid")
    out = out.withColumn(name, (F.col("__off") + F.col("__mono") - F.col("__m0") + 1).cast("bigint"))
    return out.drop("__pid", "__mono", "__n", "__off", "__m0")


def latest_per_key(df: DataFrame, keys: Sequence[str], ts: ColumnOrName, tiebreak: ColumnOrName) -> DataFrame:
    """The most recent row per key (``ts desc, tiebreak desc``)."""
    return keep_last_per_key(df, keys, [ts, tiebreak])
