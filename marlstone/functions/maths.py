"""Numeric column functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def distance(x0: Column, y0: Column, x1: Column, y1: Column) -> Column:
    """Euclidean distance in the unit of the coordinates."""
    dx, dy = x1 - x0, y1 - y0
    return F.sqrt(dx * dx + dy * dy)


def in_box(x: Column, y: Column, min_x: Column, min_y: Column, max_x: Column, max_y: Column) -> Column:
    """Containment with both ends included."""
    return x.between(min_x, max_x) & y.between(min_y, max_y)


def uniform(key: Column, seed: int) -> Column:
    """A draw in [0, 1) fixed by ``key`` and ``seed``.

    Unlike ``rand`` it does not depend on the row's partition or position, so a lost task that is
    run again draws the same numbers.
    """
    digest = F.md5(F.concat_ws(":", F.lit(str(seed)), key.cast("string")).cast("binary"))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") / F.lit(4294967296.0)


def population_sd(total: Column, squares: Column, n: Column) -> Column:
    """Population standard deviation from a sum, a sum of squares and a count.

    Sums of values on a grid (whole or half stars) are exact in any order of addition, so repeated
    runs agree to the last digit and equal values give exactly zero.
    """
    return F.sqrt(F.greatest(n * squares - total * total, F.lit(0.0))) / n
