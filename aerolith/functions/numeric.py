"""Numeric helpers shared by all operators (SC12, SC16, DQ4)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def clean_double(c: Column | str) -> Column:
    """Cast to double and map NaN to NULL.

    pandas has one missing value (NaN); Spark has NULL and NaN and sorts NaN
    above every number, so every numeric input is normalised once here.
    ``nanvl`` references its input once, which keeps generated code small
    when the input is itself a large expression.
    """
    return F.nanvl(_col(c).cast("double"), F.lit(None).cast("double"))


def nan_to_null(c: Column | str) -> Column:
    """NaN -> NULL (keeps infinities)."""
    d = _col(c).cast("double")
    return F.when(F.isnan(d), F.lit(None).cast("double")).otherwise(d)


def safe_double(c: Column | str, default: float | None = None) -> Column:
    """SC12 / DQ4: lenient numeric coercion; unparsable -> NULL (or ``default``)."""
    d = _col(c).try_cast("double")
    d = F.when(F.isnan(d), F.lit(None).cast("double")).otherwise(d)
    return d if default is None else F.coalesce(d, F.lit(float(default)))


def relative_change(current: Column | str, baseline: Column | str) -> Column:
    """SC16: (current - baseline), NULL when the baseline is missing or <= 0."""
    cur, base = _col(current), _col(baseline)
    return F.when(base.isNotNull() & (base > 0), cur - base)


def percent_change(current: Column | str, baseline: Column | str) -> Column:
    """SC16: change relative to the baseline in percent, NULL when baseline <= 0."""
    cur, base = _col(current), _col(baseline)
    return F.when(base.isNotNull() & (base > 0), (cur - base) / base * F.lit(100.0))


def r6(c: Column | str) -> Column:
    """Round a reported double to 6 decimals (half-up) for stable reports."""
    return F.round(_col(c).cast("double"), 6)
