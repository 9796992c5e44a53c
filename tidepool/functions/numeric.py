"""Aggregates whose result does not depend on partial-aggregation order.

At scale the order in which partial sums meet differs run to run; summing
doubles would make the last digits (and so rounding) drift.  Money is summed as
``decimal(28,8)`` and averages of whole numbers are rounded half-up from the
exact integer ratio.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def money_sum(c) -> Column:
    """``round(sum(x), 2)`` as double: summed at eight decimals, whatever the order, and rounded once.

    Values that a decimal of that scale cannot hold (NaN, infinities, 1e20 and over)
    make the whole sum a double sum, so none of them is lost.
    """
    x = _col(c).cast("double")
    exact = x.try_cast("decimal(28,8)")
    return F.when(F.count(exact) == F.count(x), F.round(F.sum(exact), 2).cast("double")).otherwise(F.round(F.sum(x), 2))


def exact_avg_round(name: str, digits: int = 2) -> Column:
    """``round(avg(x), digits)`` (half away from zero) for an integer column, exact.

    Uses integer ``div`` on the exact sum and count, so no double ever holds
    an intermediate; null when the group has no non-null values.
    """
    scale = 10 ** digits
    s = f"sum(cast(`{name}` as bigint))"
    n = f"count(`{name}`)"
    return F.expr(f"cast(cast(sign({s}) as bigint) * ((abs({s}) * {2 * scale} + {n}) div (2 * {n}))"
                  f" as double) / {scale}.0D")
