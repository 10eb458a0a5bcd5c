"""Money sums and ratios."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Money is summed as decimals.  They add up the same in any order, so a retried or
# re-planned job returns the same total to the last bit, and a sum has 28 digits before
# the point.
MONEY = "decimal(28,10)"


def money_sum(amount: Column) -> Column:
    return F.sum(amount.cast(MONEY)).cast("double")


def money_avg(amount: Column) -> Column:
    """Mean of the non-null amounts, null when there are none."""
    return F.try_divide(money_sum(amount), F.count(amount))


def safe_ratio(part: Column, whole: Column) -> Column:
    """Null, not an error, when ``whole`` is zero."""
    return part / F.nullif(whole, F.lit(0))


def growth_pct(now: Column, before: Column) -> Column:
    """Percent growth rounded to 2; a zero base is an error."""
    return F.round((now - before) / before * F.lit(100), 2)


def clamp01(value: Column) -> Column:
    return F.least(F.lit(1.0), F.greatest(F.lit(0.0), value))
