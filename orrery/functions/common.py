"""Small column helpers shared by the operator modules."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def round_half_up(c: ColumnOrName, scale: int = 2) -> Column:
    """Round half away from zero on the decimal value of ``c``.

    The value is first fixed to 6 decimals so that the last-bit noise of a
    floating-point sum (which depends on the order partitions are merged)
    cannot move a result across a rounding boundary. Output is a double.
    """
    return F.round(col(c).cast("decimal(38,6)"), scale).cast("double")


def round_half_even(c: ColumnOrName, scale: int = 2) -> Column:
    """Banker's rounding (pandas / Python ``round``)."""
    return F.bround(col(c).cast("decimal(38,6)"), scale).cast("double")


def safe_div(num: ColumnOrName, den: ColumnOrName) -> Column:
    """Division that yields null on a zero or null denominator (ANSI-safe)."""
    return F.try_divide(col(num).cast("double"), col(den).cast("double"))


def pct(num: ColumnOrName, den: ColumnOrName) -> Column:
    return F.try_multiply(safe_div(num, den), F.lit(100.0))


def null_safe_not_in(c: ColumnOrName, values: Iterable) -> Column:
    """``~isin`` that keeps null rows, as pandas does (SQL would drop them)."""
    return ~F.coalesce(col(c).isin(list(values)), F.lit(False))


def first_present(columns: Iterable[str], candidates: Iterable[str], contains: bool = True) -> str | None:
    """IO15: first candidate column present exactly, then by substring."""
    cols = list(columns)
    lowered = {c.lower(): c for c in cols}
    cands = list(candidates)
    for cand in cands:
        if cand.lower() in lowered:
            return lowered[cand.lower()]
    if contains:
        for cand in cands:
            for c in cols:
                if cand.lower() in c.lower():
                    return c
    return None
