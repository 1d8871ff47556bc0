"""Number operators N1-N13 as native column expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from .common import ColumnOrName, col, round_half_even, round_half_up, safe_div

# Text the number parsers read as missing.
NUMBER_SENTINELS = ("", "nan", "none", "null", "-", "—")
# Words read as true / false.
TRUE_WORDS = ("1", "true", "t", "yes", "y", "si", "sí")
FALSE_WORDS = ("0", "false", "f", "no", "n")


def _sentinel_null(x: Column) -> Column:
    return F.when(F.lower(x).isin(list(NUMBER_SENTINELS)), F.lit(None)).otherwise(x)


def parse_spanish_number(c: ColumnOrName) -> Column:
    """N1: '1.234,56' -> 1234.56 ('.' thousands, ',' decimal, '%' dropped,
    sentinels and unparsable text -> null)."""
    x = F.trim(col(c).cast("string"))
    x = F.replace(F.replace(F.replace(x, F.lit("."), F.lit("")), F.lit(","), F.lit(".")), F.lit("%"), F.lit(""))
    return _sentinel_null(x).try_cast("double")


def parse_number_auto(c: ColumnOrName) -> Column:
    """Detect the format per value: both separators -> Spanish (N1);
    only a comma -> comma decimal; otherwise a plain number."""
    x = F.trim(col(c).cast("string"))
    has_dot, has_comma = x.contains("."), x.contains(",")
    return (F.when(has_dot & has_comma, parse_spanish_number(x))
            .when(has_comma, _sentinel_null(F.replace(x, F.lit(","), F.lit("."))).try_cast("double"))
            .otherwise(_sentinel_null(x).try_cast("double")))


def parse_comma_decimal(c: ColumnOrName) -> Column:
    """Comma decimal only ('12,5' -> 12.5)."""
    return F.replace(F.trim(col(c).cast("string")), F.lit(","), F.lit(".")).try_cast("double")


def parse_currency(c: ColumnOrName, symbol: str = "€", scale_above: float = 1000.0,
                   divisor: float = 100.0) -> Column:
    """Remove the currency sign, parse as N1, then repair the scale of
    values above ``scale_above`` (cents written without a separator)."""
    x = F.trim(F.replace(col(c).cast("string"), F.lit(symbol), F.lit("")))
    v = parse_spanish_number(x)
    return F.when(v > scale_above, v / divisor).otherwise(v)


def rescale_by_source(value: ColumnOrName, source: ColumnOrName, sources: Sequence[str],
                      divisor: float = 20.0) -> Column:
    """Rescale the values of some sources (0-100 ratings to 0-5)."""
    return F.when(col(source).isin(list(sources)), col(value) / divisor).otherwise(col(value))


def to_boolean(c: ColumnOrName) -> Column:
    """Tolerant boolean from words; anything else -> null."""
    x = F.lower(F.trim(col(c).cast("string")))
    return (F.when(x.isin(list(TRUE_WORDS)), F.lit(True))
            .when(x.isin(list(FALSE_WORDS)), F.lit(False)))


def to_integer(c: ColumnOrName) -> Column:
    """Coerce to a nullable integer (fractions truncated, text -> null)."""
    return col(c).cast("string").try_cast("double").try_cast("bigint")


def round_to(c: ColumnOrName, scale: int = 2, half_even: bool = False) -> Column:
    """Half-up (SQL views) or half-even (pandas) rounding."""
    return round_half_even(c, scale) if half_even else round_half_up(c, scale)


def pct_change(base: ColumnOrName, other: ColumnOrName) -> Column:
    """(other - base) / base * 100, null when base is 0 or null."""
    return F.try_multiply(safe_div(col(other) - col(base), col(base)), F.lit(100.0))


def row_mean(*cols: ColumnOrName, ignore_nulls: bool = True) -> Column:
    """Mean across columns. ``ignore_nulls`` follows pandas
    (nulls skipped, all-null -> null); otherwise any null gives null."""
    cs = [col(c).cast("double") for c in cols]
    if not ignore_nulls:
        total = cs[0]
        for c in cs[1:]:
            total = total + c
        return total / F.lit(float(len(cs)))
    total = F.lit(0.0)
    n = F.lit(0)
    for c in cs:
        total = total + F.coalesce(c, F.lit(0.0))
        n = n + F.when(c.isNotNull(), 1).otherwise(0)
    return F.try_divide(total, F.nullif(n, F.lit(0)).cast("double"))


def fixed_bins(c: ColumnOrName, edges: Sequence[float], labels: Sequence[str],
               include_lowest: bool = False) -> Column:
    """Right-closed bins (lo, hi]; values outside -> null. With
    ``include_lowest`` the first bin is [lo, hi]."""
    if len(labels) != len(edges) - 1:
        raise ValueError("need one label per bin")
    x = col(c)
    expr = None
    for i, label in enumerate(labels):
        lo, hi = edges[i], edges[i + 1]
        lower_ok = (x >= lo) if (include_lowest and i == 0) else (x > lo)
        cond = lower_ok & (x <= hi)
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr


def bins_from_edges(c: ColumnOrName, edges: Sequence[Column], labels: Sequence[str]) -> Column:
    """N12 helper: right-closed bins with data-driven edges, lowest included."""
    x = col(c)
    expr = None
    for i, label in enumerate(labels):
        lower_ok = (x >= edges[i]) if i == 0 else (x > edges[i])
        cond = lower_ok & (x <= edges[i + 1])
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr


def weighted_sum(weights: dict[str, float] | Sequence[tuple[ColumnOrName, float]]) -> Column:
    """Sum of weight * score."""
    items = weights.items() if isinstance(weights, dict) else weights
    total = None
    for c, w in items:
        term = col(c) * F.lit(float(w))
        total = term if total is None else total + term
    return total
