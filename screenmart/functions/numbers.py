"""Exact ratios and money-period conversion."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Periods per year; an hourly amount is read as a 40-hour week.
PERIODS_PER_YEAR = {
    "yearly": 1,
    "monthly": 12,
    "weekly": 52,
    "hourly": 40 * 52,
    "biweekly": 26,
    "semimonthly": 24,
}

# The dashboard's own month factors.
MONTH_FACTORS = {"monthly": 1.0, "weekly": 4.35, "biweekly": 2.175, "semimonthly": 2.0}


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def round_ratio(num: Column | str, den: Column | str, places: int, scale: int = 1) -> Column:
    """``round(scale * num / den, places)``, half up, by integer arithmetic.

    ``num`` and ``den`` are non-negative whole numbers. Integers keep a tie such
    as x.x5 from depending on its nearest double. NULL when ``den`` is 0; counts
    too large for a bigint product raise instead of wrapping.
    """
    unit = 10**places
    n = col(num).cast("bigint")
    d = F.nullif(col(den).cast("bigint"), F.lit(0).cast("bigint"))
    doubled = n * F.lit(2 * unit * scale).cast("bigint") + d
    return F.call_function("div", doubled, d * F.lit(2)).cast("double") / F.lit(float(unit))


def pct(num: Column | str, den: Column | str, places: int = 1) -> Column:
    return round_ratio(num, den, places, scale=100)


def share(num: Column | str, den: Column | str) -> Column:
    """Unrounded fraction as double; NULL when the denominator is 0."""
    return col(num).cast("double") / F.nullif(col(den), F.lit(0)).cast("double")


def annual_amount(amount: Column, frequency: Column) -> Column:
    """Amount per year; NULL for an unknown frequency."""
    out = None
    for name, periods in PERIODS_PER_YEAR.items():
        value = amount * F.lit(periods)
        out = F.when(frequency == name, value) if out is None else out.when(frequency == name, value)
    return out


def monthly_amount(amount: Column, frequency: Column, hours_worked: Column | None = None) -> Column:
    """Dashboard month value; an unknown frequency passes the amount through."""
    value = amount.cast("double")
    out = F.when(frequency == "yearly", value / F.lit(12.0))
    for name, factor in MONTH_FACTORS.items():
        out = out.when(frequency == name, value * F.lit(factor))
    if hours_worked is not None:
        hours = F.coalesce(hours_worked, F.lit(0)).cast("double")
        out = out.when(frequency == "hourly", value * hours * F.lit(4.35))
    return out.otherwise(value)


def banded(value: Column, bands: list[tuple[str, Column]], default: str | None = None) -> tuple[Column, Column]:
    """First matching band as (label, 1-based order)."""
    label = order = None
    for i, (name, cond) in enumerate(bands, start=1):
        label = F.when(cond, name) if label is None else label.when(cond, name)
        order = F.when(cond, i) if order is None else order.when(cond, i)
    if default is not None:
        label, order = label.otherwise(default), order.otherwise(len(bands) + 1)
    return label, order


def upper_bounded(value: Column, bounds: list[tuple[float, str]], default: str) -> tuple[Column, Column]:
    return banded(value, [(name, value < F.lit(bound)) for bound, name in bounds], default)
