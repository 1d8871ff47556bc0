"""Sorts, limits and top-k (T1-T7). ``orderBy(...).limit(n)`` plans as
TakeOrderedAndProject: each task keeps its own top n, so only n rows per
task reach the final merge."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def top_n(df: DataFrame, order: Sequence[Column], n: int, tiebreak: Sequence[str] = ()) -> DataFrame:
    """The first n rows of an order (the limit is the
    feature: a top-n report or a capped listing)."""
    return df.orderBy(*order, *[F.col(c).asc() for c in tiebreak]).limit(n)


def bottom_and_top(df: DataFrame, value: str, n: int, tiebreak: Sequence[str] = (),
                   side_col: str = "side", rank_col: str = "rank") -> DataFrame:
    """The n smallest and n largest rows, tagged 'low' / 'high'."""
    low = (df.orderBy(F.col(value).asc(), *[F.col(c).asc() for c in tiebreak]).limit(n)
           .withColumn(side_col, F.lit("low")))
    high = (df.orderBy(F.col(value).desc(), *[F.col(c).asc() for c in tiebreak]).limit(n)
            .withColumn(side_col, F.lit("high")))
    from pyspark.sql import Window
    w = Window.partitionBy(side_col).orderBy(
        F.when(F.col(side_col) == "low", F.col(value)).otherwise(-F.col(value)), *[F.col(c) for c in tiebreak])
    return low.unionByName(high).withColumn(rank_col, F.row_number().over(w))


def keys_by_aggregate(df: DataFrame, key: str, metric: Column, descending: bool = True) -> DataFrame:
    """Keys ordered by an aggregate that is not projected."""
    g = df.groupBy(key).agg(metric.alias("__m"))
    o = F.col("__m").desc() if descending else F.col("__m").asc()
    return g.orderBy(o, F.col(key).asc()).select(key)
