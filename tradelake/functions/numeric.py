"""Rounding and safe arithmetic.

``round_half_away`` rounds the binary double the way a C ``round(x*10^n)/10^n``
does.  Spark's own ``round`` on a double first turns the value into its
shortest decimal text, so ``round(1.005, 2)`` gives 1.01 in Spark but 1.0 in
engines that round the binary value.  Scaling first, then rounding to an
integer, gives the binary answer in both.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def round_half_away(c: Column | str, digits: int) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    scale = float(10 ** digits)
    r = F.round(c * F.lit(scale), 0) / F.lit(scale)
    # IEEE rounding keeps the sign of a value that rounds to zero (-0.0);
    # Spark's decimal-based round loses it, so restore it from the input.
    return F.when(r == 0, F.lit(0.0) * F.signum(c)).otherwise(r)


def safe_div(num: Column, den: Column) -> Column:
    """``num / nullif(den, 0)``: NULL instead of an ANSI divide-by-zero error."""
    return num / F.nullif(den, F.lit(0))


def as_decimal(c: Column | str, scale: int = 8) -> Column:
    """Exact fixed-point copy of a rounded double, for order-independent sums."""
    c = F.col(c) if isinstance(c, str) else c
    return c.cast(f"decimal(38,{scale})")


# Exact sums.  Double sums depend on the order rows are added in, which on a
# cluster depends on partitioning; a value near a rounding boundary then flips
# between runs.  ``xsum`` adds fixed-point copies (exact, any order) and returns
# the nearest double of the exact total -- what an ideal double summation
# gives -- so the formulas after it keep plain double semantics.  ``scale``
# must cover the decimals the values carry (quantities 10, USD volume 6).

def xsum(c: Column | str, scale: int) -> Column:
    """Order-independent ``sum`` of a double column, returned as double."""
    return F.sum(as_decimal(c, scale)).cast("double")


def xavg(c: Column | str, scale: int) -> Column:
    """``avg`` as exact sum / count (NULLs ignored, like ``avg``)."""
    c = F.col(c) if isinstance(c, str) else c
    return xsum(c, scale) / F.nullif(F.count(c), F.lit(0)).cast("double")


def xsum_over(c: Column | str, scale: int, window) -> Column:
    """``xsum`` as a window aggregate."""
    return F.sum(as_decimal(c, scale)).over(window).cast("double")
