"""Plane geometry on columns. Points are x/y pairs of doubles, y grows downwards."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# How far two angles of one edge may differ, and how far its segments may lie apart.
PARALLEL_LIMIT = 8 * math.pi / 180
DISTANCE_LIMIT = 30.0


def near_parallel(a: Column, b: Column, limit: float = PARALLEL_LIMIT) -> Column:
    """Directions within `limit` of each other, where a half turn makes no difference."""
    gap = a - b
    return F.least(F.abs(gap), F.abs(gap + math.pi), F.abs(gap - math.pi)) < limit


def side_of_line(x1: Column, y1: Column, x2: Column, y2: Column, px: Column, py: Column) -> Column:
    """Signed distance of a point from the line through (x1,y1) and (x2,y2); null where the two coincide."""
    cross = (x2 - x1) * (py - y1) - (y2 - y1) * (px - x1)
    return F.try_divide(cross, F.sqrt((x2 - x1) * (x2 - x1) + (y2 - y1) * (y2 - y1)))


def line_to_segment(line: str, seg: str) -> Column:
    """Larger distance of the ends of `seg` from the line of `line`; 0 where they lie on both sides.

    Null where `line` has no length.
    """
    c = lambda side, name: F.col(f"{side}.{name}")
    ends = [
        side_of_line(c(line, "x1"), c(line, "y1"), c(line, "x2"), c(line, "y2"), c(seg, f"x{k}"), c(seg, f"y{k}"))
        for k in (1, 2)
    ]
    return F.when(ends[0] * ends[1] <= 0, F.lit(0.0)).otherwise(F.greatest(F.abs(ends[0]), F.abs(ends[1])))


def distance(x1: Column, y1: Column, x2: Column, y2: Column) -> Column:
    return F.sqrt((x2 - x1) * (x2 - x1) + (y2 - y1) * (y2 - y1))


def distance2(x1: Column, y1: Column, x2: Column, y2: Column) -> Column:
    """Squared distance: exact on whole pixels, and enough to compare."""
    return (x2 - x1) * (x2 - x1) + (y2 - y1) * (y2 - y1)


def whole(value: Column) -> Column:
    """Fraction cut off, as a long; null for what no long can hold."""
    return value.try_cast("long")
