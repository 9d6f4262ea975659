"""Arithmetic helpers: rounding, guarded division, labels.

Money is summed as DECIMAL and divided as DOUBLE, so ratios keep full precision
whatever the scale of their inputs.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def dbl(c: Column | str) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("double")


def rnd(c: Column, places: int = 0) -> Column:
    """Round a DOUBLE half away from zero at ``places`` decimals (scaled rule)."""
    if places == 0:
        return F.round(dbl(c))
    scale = float(10**places)
    return F.round(dbl(c) * scale) / scale


def money(c: Column | str) -> Column:
    """Round a DECIMAL amount to cents."""
    return F.round(F.col(c) if isinstance(c, str) else c, 2)


def ratio(num: Column, den: Column) -> Column:
    """num / den as DOUBLE; NULL when the denominator is zero or NULL."""
    return F.try_divide(dbl(num), dbl(den))


def pct(num: Column, den: Column, places: int = 1) -> Column:
    return rnd(ratio(num, den) * 100.0, places)


def mean(c: Column) -> Column:
    """Average as exact sum over count, divided once in DOUBLE."""
    return ratio(F.sum(c), F.count(c))


def share_true(cond: Column) -> Column:
    """Fraction of rows where ``cond`` is true; NULL counts as not true."""
    return ratio(F.count(F.when(cond, 1)), F.count(F.lit(1)))


def count_where(cond: Column) -> Column:
    return F.count(F.when(cond, 1))


def sum_where(cond: Column, c: Column) -> Column:
    """Conditional total that is zero, not NULL, when nothing matches."""
    return F.sum(F.when(cond, c).otherwise(F.lit(0).cast("decimal(18,4)")))


def divide_or(num: Column, den: Column, default: float = 0.0) -> Column:
    """num / den, or ``default`` when the denominator is zero or NULL."""
    return F.when(den.isNull() | (den == 0), F.lit(float(default))).otherwise(ratio(num, den))


def cents_to_dollars(c: Column) -> Column:
    return rnd(dbl(c) / 100.0, 2)


def _null_if_any(cols: list[Column], value: Column) -> Column:
    return F.when(reduce(lambda a, b: a & b, [c.isNotNull() for c in cols]), value)


def smallest(*cols: Column) -> Column:
    """LEAST that is NULL as soon as one input is NULL."""
    return _null_if_any(list(cols), F.least(*cols))


def largest(*cols: Column) -> Column:
    """GREATEST that is NULL as soon as one input is NULL."""
    return _null_if_any(list(cols), F.greatest(*cols))


def decay(days: Column, half_life: float = 7.0) -> Column:
    """Half-life weight: 1 at day 0, 0.5 after ``half_life`` days."""
    return F.pow(F.lit(0.5), dbl(days) / float(half_life))


def annualised(growth: Column) -> Column:
    quarter = (growth + 1.0) * (growth + 1.0) * (growth + 1.0)  # products give the same last digit everywhere, powers do not
    return quarter * quarter * quarter * quarter - 1.0


def money_label(c: Column) -> Column:
    """$1.14M, $94.8K or $79."""
    v = dbl(c)
    return (
        F.when(v >= 1e6, F.format_string("$%.2fM", rnd(v / 1e6, 2)))
        .when(v >= 1e3, F.format_string("$%.1fK", rnd(v / 1e3, 1)))
        .when(v.isNotNull(), F.format_string("$%.0f", rnd(v)))
    )


def trend_arrow(c: Column) -> Column:
    return F.when(c >= 0, F.lit("▲")).when(c < 0, F.lit("▼"))
