"""Date operators D-1 to D-8."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from .common import ColumnOrName, col

# Month names, season months and lead-time months.
MONTH_NAMES = ("Enero", "Febrero", "Marzo", "Abril", "Mayo", "Junio", "Julio",
               "Agosto", "Septiembre", "Octubre", "Noviembre", "Diciembre")
HIGH_SEASON_MONTHS = (7, 8, 12)
MID_SEASON_MONTHS = (4, 5, 6, 9, 10)
SEASON_LABELS = ("alta", "media", "baja")
LEAD_TIME_HIGH_MONTHS = (6, 7, 8, 12)
LEAD_TIME_LABELS = ("2-3 meses", "1 mes")
# Friday and Saturday nights count as weekend (dayofweek: Sunday = 1).
WEEKEND_DAYS = (6, 7)


def trip_days(start: ColumnOrName, end: ColumnOrName) -> Column:
    """D-1: days including both ends."""
    return F.datediff(col(end), col(start)) + 1


def trip_nights(start: ColumnOrName, end: ColumnOrName) -> Column:
    """D-1: nights = end - start."""
    return F.datediff(col(end), col(start))


def night_dates(start: ColumnOrName, end: ColumnOrName) -> Column:
    """D-2: array of the nights start .. end-1 (empty-safe: null when there
    is no night, so ``explode`` yields no row instead of an error or a
    descending series)."""
    s, e = col(start).cast("date"), col(end).cast("date")
    last = F.date_sub(e, 1)
    return F.when(last >= s, F.sequence(s, last, F.expr("INTERVAL 1 DAY")))


def is_weekend_night(d: ColumnOrName, weekend_days: Sequence[int] = WEEKEND_DAYS) -> Column:
    return F.dayofweek(col(d)).isin(list(weekend_days))


def count_weekdays(start: ColumnOrName, n_days: ColumnOrName, days: Sequence[int]) -> Column:
    """D-2 without a generated series: how many of the ``n_days`` dates
    from ``start`` fall on the given ``dayofweek`` values (Sunday = 1).
    For weekday w and r = (w - dayofweek(start)) mod 7, the dates at offsets
    r, r + 7, ... below n count: floor((n - r + 6) / 7)."""
    n = F.greatest(col(n_days).cast("int"), F.lit(0))
    sd = F.dayofweek(col(start))
    total = None
    for w in days:
        r = F.pmod(F.lit(w) - sd, F.lit(7))
        c = F.floor((n - r + 6) / 7).cast("int")
        total = c if total is None else total + c
    return total


def days_until(d: ColumnOrName, as_of: ColumnOrName) -> Column:
    """D-3: days remaining until ``d``, floored at 0."""
    return F.greatest(F.datediff(col(d), col(as_of)), F.lit(0))


def months_until(d: ColumnOrName, as_of: ColumnOrName) -> Column:
    """D-3: months remaining = max(round_half_even(days/30), 1)."""
    days = days_until(d, as_of)
    return F.greatest(F.bround(days.cast("double") / 30.0, 0).cast("int"), F.lit(1))


def season_of_month(month: ColumnOrName) -> Column:
    """D-4 season rule (calendar)."""
    m = col(month)
    return (F.when(m.isin(list(HIGH_SEASON_MONTHS)), F.lit(SEASON_LABELS[0]))
            .when(m.isin(list(MID_SEASON_MONTHS)), F.lit(SEASON_LABELS[1]))
            .when(m.isNotNull(), F.lit(SEASON_LABELS[2])))


def quarter_of_month(month: ColumnOrName) -> Column:
    return (F.floor((col(month) - 1) / 3) + 1).cast("int")


def month_name(month: ColumnOrName, names: Sequence[str] = MONTH_NAMES) -> Column:
    return F.element_at(F.array(*[F.lit(n) for n in names]), col(month).cast("int"))


def lead_time_for_month(month: ColumnOrName, high_months: Sequence[int] = LEAD_TIME_HIGH_MONTHS,
                        labels: Sequence[str] = LEAD_TIME_LABELS) -> Column:
    """D-6: lead-time rule by month; null month -> null."""
    m = col(month)
    return F.when(m.isin(list(high_months)), F.lit(labels[0])).when(m.isNotNull(), F.lit(labels[1]))


def month_start(d: ColumnOrName) -> Column:
    """D-7: first day of the month."""
    return F.trunc(col(d).cast("date"), "month")


def year_month(d: ColumnOrName) -> Column:
    """D-7: ``yyyy-MM`` month period."""
    return F.date_format(col(d), "yyyy-MM")


def date_from_parts(year: ColumnOrName, month: ColumnOrName, day: ColumnOrName | int = 1) -> Column:
    d = F.lit(day) if isinstance(day, int) else col(day)
    return F.try_make_date(col(year), col(month), d) if hasattr(F, "try_make_date") else F.make_date(col(year), col(month), d)


def coerce_date(c: ColumnOrName, fmt: str | None = None) -> Column:
    """D-8: text to date, unparsable -> null."""
    x = col(c).cast("string")
    return F.try_to_date(x, F.lit(fmt)) if fmt else F.try_to_date(x)
