"""Numeric helpers that keep aggregates independent of row order."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def units_of(c: str, scale: int) -> Column:
    """A value in whole ``10**-scale`` units, NULL where it has no BIGINT form (infinite, NaN, too large)."""
    return F.round(F.col(c) * (10 ** scale)).try_cast("bigint")


def exact_avg(c: str, scale: int) -> Column:
    """Average of a column whose values carry at most ``scale`` decimals.

    A double sum depends on the order rows arrive in, so the same data on a
    different partitioning can change the last bits. Summing the values as
    integers of ``10**-scale`` units is exact (and cheap: a BIGINT sum), so
    the result depends only on the data. If a value, or the sum, has no BIGINT
    form, the result is the plain double average.
    """
    return avg_of_units(F.try_sum(units_of(c, scale)), F.count(units_of(c, scale)), F.count(c), F.avg(c), scale)


def avg_of_units(total: Column, exact: Column, count: Column, plain: Column, scale: int) -> Column:
    """The average from the sum of units if it covers all ``count`` values, else ``plain``."""
    return F.when((exact == count) & total.isNotNull(), F.try_divide(total / F.lit(float(10 ** scale)), count)).otherwise(plain)
