"""Numeric helpers that give the same answer on every partitioning.

Money is double in the data model, but a double SUM depends on the order in
which 1000 executors combine partials.  Totals are therefore summed in DECIMAL
with ten decimals, no digit of money is cut, and converted back to double once.
Values that such a decimal can't hold (18 integer digits or more, infinities)
are summed as doubles beside it.  Rounding is HALF_UP on the decimal value, so
ROUND never flips on a binary representation artefact.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EXACT = "decimal(28,10)"


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def round_half_up(c: Column | str, digits: int = 2) -> Column:
    """ROUND(x, d) HALF_UP on the decimal value of x, returned as double."""
    c = _c(c)
    return F.coalesce(F.round(c.try_cast("decimal(38,10)"), digits).cast("double"), c.cast("double"))


def exact_part(c: Column | str) -> Column:
    """The value as an exact decimal; NULL where it is out of a decimal's range."""
    return _c(c).cast("double").try_cast(EXACT)


def double_part(c: Column | str) -> Column:
    """The value where ``exact_part`` can't hold it, else NULL."""
    return F.when(exact_part(c).isNull(), _c(c).cast("double"))


def money_total(exact_sum: Column, double_sum: Column) -> Column:
    """The total of both parts' sums; NULL where neither has a value."""
    plain = exact_sum.cast("double")
    return F.when(double_sum.isNull(), plain).otherwise(F.coalesce(plain, F.lit(0.0)) + double_sum)


def money_sum(c: Column | str) -> Column:
    """SUM of a money column as double, whatever its digits."""
    return money_total(F.sum(exact_part(c)), F.sum(double_part(c)))


def money_avg(c: Column | str) -> Column:
    """``money_sum`` / COUNT(non-null) of a money column as double."""
    return safe_div(money_sum(c), F.count(_c(c)))


def safe_div(num: Column, den: Column) -> Column:
    """num / NULLIF(den, 0)."""
    return num / F.nullif(den, F.lit(0))
