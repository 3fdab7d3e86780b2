"""Sums, means and variances of doubles that do not depend on the order of rows.

A double splits without error into a whole number and two parts of its fraction,
26 and 27 bits scaled to whole numbers. Sums of whole numbers are exact in
double arithmetic as long as they stay below 2^53, whatever the order in which
tasks add them, so the same rows give the same bits however they are dealt out,
and in any engine that adds them. What a value has below 2^-53 is cut off. Beyond
2^53 (a sum of amounts over 9 * 10^15, or a group of more than 10^8 rows in the
fraction parts) a sum rounds like any other; squares, which get there sooner,
have their whole numbers split once more (``wide``), which holds up to 6 * 10^23.
NaN and infinite values pass into the result. All parts are plain sums with
partial aggregation.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

HIGH, LOW = float(2 ** 26), float(2 ** 27)   # scales of the two parts of a fraction
WHOLE = float(2 ** 53)                       # from here on a double has no fraction


def parts(x: Column) -> tuple[Column, Column, Column]:
    """Whole number, scaled high and low part of the fraction of ``x``; their sum is ``x``."""
    whole = F.when(F.abs(x) < F.lit(WHOLE), F.floor(x).cast("double")).otherwise(x)
    scaled = (x - whole) * F.lit(HIGH)
    high = F.floor(scaled).cast("double")
    return whole, high, F.floor((scaled - high) * F.lit(LOW)).cast("double")


def exact_sum(c: Column, wide: bool = False) -> Column:
    """Sum of a double column; NULL if there is no value."""
    x = c.cast("double")
    if wide:
        top = F.when(F.abs(x) < F.lit(WHOLE * HIGH), F.floor(x / F.lit(HIGH)).cast("double")).otherwise(x / F.lit(HIGH))
        x = x - top * F.lit(HIGH)
    whole, high, low = (F.sum(p) for p in parts(x))
    total = whole + (high + low / F.lit(LOW)) / F.lit(HIGH)
    return F.sum(top) * F.lit(HIGH) + total if wide else total


def exact_mean(c: Column) -> Column:
    return F.try_divide(exact_sum(c), F.count(c).cast("double"))


def _variance(c: Column, less: int) -> Column:
    x = c.cast("double")
    n, total, squares = F.count(x).cast("double"), exact_sum(x), exact_sum(x * x, wide=True)
    spread = F.greatest(F.lit(0.0), squares - F.try_divide(total * total, n))
    # A constant column has no variance, whatever its square rounds to.
    return F.try_divide(F.when(F.min(x) == F.max(x), F.lit(0.0)).otherwise(spread), n - F.lit(float(less)))


def exact_var_pop(c: Column) -> Column:
    return _variance(c, 0)


def exact_var_samp(c: Column) -> Column:
    """NULL for a single value."""
    return _variance(c, 1)
