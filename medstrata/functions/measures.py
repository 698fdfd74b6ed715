"""Exact and reproducible arithmetic for reports.

Sums of binary doubles depend on the order of addition, which differs from run to
run on a cluster.  Money is therefore added as decimals, to a millionth of a cent, and
turned back into a double at the end; only results are rounded.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

MONEY = "decimal(28,8)"
_ROUNDING = "decimal(28,10)"


def _column(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def money(value: Column | str) -> Column:
    """The amount as a decimal; NULL for one of 1e20 or more, which no sum could hold."""
    return _column(value).try_cast(MONEY)


def unfit(value: Column | str) -> Column:
    """Number of amounts that :func:`money` cannot hold."""
    return F.count_if(_column(value).isNotNull() & money(value).isNull())


def exact_sum(value: Column | str) -> Column:
    """Order-independent sum of an amount column, as a double."""
    return F.sum(money(value)).cast("double")


def money_mean(total: Column, count: Column, digits: int = 2) -> Column:
    """Mean of an exact (decimal) total, rounded half up without leaving decimals.

    A double would lose the half cents of large amounts.
    """
    return F.round(F.try_divide(total, count.cast("decimal(20,0)")), digits).cast("double")


def rounded(value: Column, digits: int) -> Column:
    """Round half up on the decimal digits of a double."""
    return F.round(value.cast(_ROUNDING), digits).cast("double")


def ratio(part: Column, whole: Column) -> Column:
    """Quotient as a double; NULL when the divisor is zero."""
    return F.try_divide(part.cast("double"), whole.cast("double"))


def mean(total: Column, count: Column, digits: int) -> Column:
    return rounded(ratio(total, count), digits)


def count_where(condition: Column) -> Column:
    """Number of rows for which ``condition`` is true (never NULL)."""
    return F.count_if(condition)
