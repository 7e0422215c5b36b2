"""Calendar and time-bucket expressions (SC8-SC10, SC18, TS2)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Meteorological seasons by month.
# ---------------------------------------------------------------------------
SEASONS = [
    ("Winter", [12, 1, 2]),
    ("Spring", [3, 4, 5]),
    ("Summer", [6, 7, 8]),
    ("Autumn", [9, 10, 11]),
]
# Display format of a forecast slot, e.g. "Mon 01 Jan, 01:05 PM".
SLOT_LABEL_FORMAT = "EEE dd MMM, hh:mm a"
# ---------------------------------------------------------------------------


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def season(month: Column | str) -> Column:
    """SC9: season name from a month number (anything else -> Autumn, as the reference)."""
    m = _col(month)
    expr = None
    for name, months in SEASONS[:-1]:
        expr = F.when(m.isin(months), F.lit(name)) if expr is None else expr.when(m.isin(months), F.lit(name))
    return expr.otherwise(F.lit(SEASONS[-1][0]))


def calendar_columns(ts: Column | str) -> dict[str, Column]:
    """SC8: hour, day, month, year, day_of_week (English name), is_weekend (Sat/Sun), season."""
    t = _col(ts)
    return {
        "hour": F.hour(t).cast("bigint"),
        "day": F.dayofmonth(t).cast("bigint"),
        "month": F.month(t).cast("bigint"),
        "year": F.year(t).cast("bigint"),
        "day_of_week": F.date_format(t, "EEEE"),
        # Spark weekday(): Monday = 0 ... Sunday = 6, same as pandas dayofweek.
        "is_weekend": (F.weekday(t) >= 5).cast("bigint"),
        "season": season(F.month(t)),
    }


def with_calendar(df: DataFrame, ts: str = "timestamp") -> DataFrame:
    return df.withColumns(calendar_columns(ts))


def floor_hours(ts: Column | str, hours: int = 3) -> Column:
    """SC10: floor a timestamp to an ``hours``-wide bucket anchored at the epoch.

    ``window(...).start`` keeps ``TIMESTAMP_NTZ``; pandas ``dt.floor('3h')``
    anchors at the epoch too, so buckets agree.
    """
    return F.window(_col(ts), f"{hours} hours").start


def floor_hour(ts: Column | str) -> Column:
    return F.date_trunc("hour", _col(ts))


def slot_label(ts: Column | str) -> Column:
    """SC18: human label of a forecast slot."""
    return F.date_format(_col(ts), SLOT_LABEL_FORMAT)


def add_hours(ts: Column | str, hours: Column | int) -> Column:
    h = hours if isinstance(hours, Column) else F.lit(int(hours))
    return _col(ts) + F.make_dt_interval(F.lit(0), h.cast("int"))
