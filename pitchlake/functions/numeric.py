"""Column helpers for numbers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def rounded(x: Column, digits: int) -> Column:
    """Half away from zero, on the scaled double: the same value in every engine."""
    scale = 10.0**digits
    return F.round(x * scale, 0) / scale


def rounded_avg(x: Column, digits: int) -> Column:
    """Rounded mean.  The order in which partitions are added moves the last bits
    of a mean; they are taken off first, so that halves round one way."""
    return rounded(rounded(F.avg(x), 9), digits)


def ratio(part: Column, whole: Column) -> Column:
    """part / whole as a double, null where whole is not positive."""
    return F.when(whole > 0, part.cast("double") / whole.cast("double"))


def plain_max(x: Column) -> Column:
    """Maximum that ignores NaN."""
    return F.max(F.nanvl(x, F.lit(None).cast("double")))


def total(x: Column) -> Column:
    """Sum that is 0 where nothing was added."""
    return F.coalesce(F.sum(x), F.lit(0)).cast("long")
