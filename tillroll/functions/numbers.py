"""Column expressions for money, shares and ratios."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W


def money(col, precision: int = 28) -> Column:
    """Two-digit money of one agreed width, so that sums compare across engines."""
    return _col(col).cast(f"decimal({precision},2)")


def real(col) -> Column:
    return _col(col).cast("double")


def ratio(numerator, denominator, factor: float = 1) -> Column:
    """``factor * numerator / denominator`` as double; NULL when the denominator is 0 or NULL."""
    top = real(numerator)
    if factor != 1:
        top = top * F.lit(float(factor))
    return F.try_divide(top, real(denominator))


def rounded_ratio(numerator, denominator, digits: int = 2, factor: int = 1) -> Column:
    """``ratio`` rounded to ``digits``, ties away from zero.

    It divides as decimal first: a binary quotient can lie just below a tie and round down.
    """
    top = _col(numerator).cast("decimal(30,2)") * F.lit(factor).cast("decimal(3,0)")
    exact = F.try_divide(top.cast("decimal(32,2)"), _col(denominator).cast("decimal(30,2)"))
    return F.round(exact, digits).cast("double")


def rounded(col, digits: int = 2) -> Column:
    """A binary number rounded as the decimal it stands for, ties away from zero."""
    return F.round(_col(col).cast("decimal(32,8)"), digits).cast("double")


def percent(numerator, denominator, digits: int = 1) -> Column:
    return rounded_ratio(numerator, denominator, digits, 100)


def share_of_total(col, digits: int = 1) -> Column:
    """Share in percent of the sum over all rows; for short, already grouped results."""
    return percent(col, F.sum(_col(col)).over(W.partitionBy()), digits)


def count(col=None) -> Column:
    return F.count(F.lit(1) if col is None else _col(col)).cast("bigint")


def _col(col) -> Column:
    return F.col(col) if isinstance(col, str) else col
