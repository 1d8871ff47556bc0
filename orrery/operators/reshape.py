"""Reshape R1-R5. Pivot values are always passed explicitly so the
schema is fixed and no extra distinct job runs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.common import round_half_up


def pivot_sum(df: DataFrame, rows: Sequence[str], pivot_col: str, values: Sequence, value: str,
              zero_fill: bool = True, total_col: str | None = "total", scale: int | None = 2,
              names: Sequence[str] | None = None) -> DataFrame:
    """Sum pivot with zero fill and a row total (callers order by it)."""
    names = list(names) if names else [str(v) for v in values]
    agg = F.sum(value)
    p = df.groupBy(*rows).pivot(pivot_col, list(values)).agg(agg)
    p = p.select(*rows, *[F.col(f"`{v}`").alias(n) for v, n in zip(values, names)])
    if zero_fill:
        p = p.fillna(0, subset=names) if names else p
        p = p.select(*rows, *[F.coalesce(F.col(n), F.lit(0.0)).alias(n) for n in names])
    if scale is not None:
        p = p.select(*rows, *[round_half_up(F.col(n), scale).alias(n) for n in names])
    if total_col:
        tot = None
        for n in names:
            tot = F.coalesce(F.col(n), F.lit(0.0)) if tot is None else tot + F.coalesce(F.col(n), F.lit(0.0))
        p = p.withColumn(total_col, round_half_up(tot, scale or 6))
    return p


def pivot_mean(df: DataFrame, rows: Sequence[str], pivot_col: str, values: Sequence, value: str,
               scale: int | None = 2, names: Sequence[str] | None = None) -> DataFrame:
    """R2: mean pivot, gaps stay null."""
    names = list(names) if names else [str(v) for v in values]
    p = df.groupBy(*rows).pivot(pivot_col, list(values)).agg(F.avg(value))
    return p.select(*rows, *[(round_half_up(F.col(f"`{v}`"), scale) if scale is not None else F.col(f"`{v}`")).alias(n)
                             for v, n in zip(values, names)])


def pivot_first(df: DataFrame, rows: Sequence[str], pivot_col: str, values: Sequence, value: str,
                names: Sequence[str] | None = None) -> DataFrame:
    """Pivot precomputed values (one per cell) with ``max``."""
    names = list(names) if names else [str(v) for v in values]
    p = df.groupBy(*rows).pivot(pivot_col, list(values)).agg(F.max(value))
    return p.select(*rows, *[F.col(f"`{v}`").alias(n) for v, n in zip(values, names)])


def unpivot(df: DataFrame, ids: Sequence[str], columns: Sequence[str], name_col: str = "category",
            value_col: str = "amount") -> DataFrame:
    """Estimate columns to (category, amount) rows."""
    return df.unpivot(list(ids), list(columns), name_col, value_col)
