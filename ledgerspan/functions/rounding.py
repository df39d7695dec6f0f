"""Rounding and exact summation of money held as doubles.

Two rules of the data model meet here:

* ``round(x, n)`` rounds ``x * 10^n`` half away from zero.  Spark's own ``round`` to n digits looks at the
  decimal text of ``x`` instead (1.005 -> 1.01, not 1.0).
* Sums of doubles depend on the order in which partitions arrive and lose cents once a group holds
  billions of rows, while a reconciliation compares against a tolerance of one cent.  ``exact_sum``
  counts millionths in longs, so its result is the same for every partitioning, at about the cost of a
  plain sum (a sum of decimals takes ten times as long).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MICRO = 1e6
# Two units in the last place: what storing and multiplying a decimal as a double can add.
DOUBLE_NOISE = 4.5e-16


def round_half_away(col: Column, digits: int) -> Column:
    """``round(col, digits)`` on the scaled double, ties away from zero."""
    scale = F.lit(float(10**digits))
    return F.round(col * scale) / scale


def exact_sum(col: Column, digits: int | None = None, divisor: Column | None = None) -> Column:
    """Order-independent ``sum(col)`` of a double, optionally ``round(sum(col), digits)``.

    Values that stand for up to six decimals are summed without any error; what is left of longer
    values (and NaN, infinities, amounts beyond nine trillion) is summed apart as a double.  The result is the
    double nearest to the total, null when the group has no value.  ``divisor`` (an integer aggregate)
    divides that total: shares with one common denominator are summed as numerators.

    ``col`` is used several times, so compute it in a ``select`` before the grouping.
    """
    micro = F.coalesce(F.rint(col * MICRO).try_cast("bigint"), F.lit(0).cast("bigint"))
    left = col - micro / MICRO
    rest = F.sum(F.when(F.abs(left) < F.abs(col) * DOUBLE_NOISE, 0.0).otherwise(left))
    # The long in two parts, whole multiples of 2^20 and the 20 bits below: no sum overflows before a group has
    # trillions of rows.
    high = F.sum(F.shiftright(micro, 20)).cast("decimal(20,0)")
    low = F.sum(micro.bitwiseAND(0xFFFFF)).cast("decimal(20,0)")
    units = ((high * F.expr("1048576BD") + low) * F.expr("0.000001BD")).cast("decimal(32,6)")
    # A remainder that is no decimal is NaN, infinite or too large to carry cents.
    total = F.coalesce((units + rest.try_cast("decimal(24,12)")).cast("double"), units.cast("double") + rest)
    if divisor is not None:
        total = total / divisor
    return total if digits is None else round_half_away(total, digits)
