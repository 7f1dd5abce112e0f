"""Sums that do not depend on the order of rows.

Adding doubles rounds at every step, so a sum of many amounts depends on partitioning. Here each amount
splits into whole units and millionths, two integers whose sums are exact in any order. The sum and the mean of a
column share these two lanes and a guard: NaN and infinite amounts, and finite ones beyond ``LARGE``, are added as
doubles, and with NaN or infinity the result is what plain addition gives. Null amounts are skipped.

The lanes hold 2**33 amounts of the largest size in one group, and more of smaller ones.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

LARGE = float(1 << 30)


def exact_sum(column: str) -> Column:
    """The sum, exact to a millionth per amount; null without amounts."""
    x = F.col(column).cast("double")
    plain = x.between(-LARGE, LARGE)  # not so for NaN
    whole = F.floor(x)
    units = F.sum(F.when(plain, whole))
    parts = F.sum(F.when(plain, F.rint((x - whole) * 1_000_000).cast("bigint")))
    guard = F.sum(F.when(~plain, x))
    # At most 38 digits: units of 19 digits and six places.
    total = units.cast("decimal(25,0)") * F.lit(1_000_000).cast("decimal(7,0)") + parts
    exact = total.cast("double") / F.lit(1e6)
    return F.when(guard.isNull(), exact).otherwise(guard + F.coalesce(exact, F.lit(0.0)))


def exact_mean(column: str) -> Column:
    """The exact sum over the number of amounts."""
    return F.try_divide(exact_sum(column), F.count(column).cast("double"))
