"""Convex hull of a shape given as runs, and the canopy ends found on it."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from calipers.functions.shapes import distance2, whole

BLOCK_ROWS = 512  # image rows whose hull is taken in one call
_POINTS = T.StructType([T.StructField(c, T.ArrayType(T.LongType())) for c in ("xs", "ys")])


def _hull(xs: np.ndarray, ys: np.ndarray) -> tuple[list[int], list[int]]:
    """Corners only, clockwise on the screen from the topmost (then leftmost) point."""
    order = np.lexsort((xs, ys))
    pts = list(dict.fromkeys(zip(xs[order].tolist(), ys[order].tolist())))

    def chain(points: list[tuple[int, int]]) -> list[tuple[int, int]]:
        kept: list[tuple[int, int]] = []
        for p in points:
            while len(kept) > 1:
                (ox, oy), (ax, ay) = kept[-2], kept[-1]
                if (ax - ox) * (p[1] - ay) - (ay - oy) * (p[0] - ax) > 0:
                    break
                kept.pop()
            kept.append(p)
        return kept

    ring = pts if len(pts) < 3 else chain(pts)[:-1] + chain(pts[::-1])[:-1]
    return [p[0] for p in ring], [p[1] for p in ring]


@F.pandas_udf(_POINTS)
def _hull_of(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
    for xs, ys in batches:
        yield pd.DataFrame([_hull(a, b) for a, b in zip(xs, ys)], columns=["xs", "ys"])


def convex_hulls(runs: DataFrame) -> DataFrame:
    """(image_id, points) with points an array of struct(x, y) in ring order.

    Only the outermost pixels of a row can be corners. Rows are taken in blocks and
    the hull of the block hulls is the hull of the shape, so no call sees more than
    two points for each of `BLOCK_ROWS` rows, or the few corners of the blocks.
    """
    ends = runs.groupBy("image_id", "y").agg(F.min("x0").alias("x0"), F.max("x1").alias("x1"))
    pts = ends.select(
        "image_id",
        F.floor(F.col("y") / BLOCK_ROWS).alias("block"),
        F.col("y").cast("long").alias("y"),
        F.explode(F.array_distinct(F.array(F.col("x0").cast("long"), F.col("x1").cast("long")))).alias("x"),
    )
    blocks = (
        pts.groupBy("image_id", "block")
        .agg(F.collect_list("x").alias("xs"), F.collect_list("y").alias("ys"))
        .select("image_id", _hull_of("xs", "ys").alias("h"))
    )
    return (
        blocks.groupBy("image_id")
        .agg(F.flatten(F.collect_list("h.xs")).alias("xs"), F.flatten(F.collect_list("h.ys")).alias("ys"))
        .select("image_id", _hull_of("xs", "ys").alias("h"))
        .select("image_id", F.arrays_zip(F.col("h.xs").alias("x"), F.col("h.ys").alias("y")).alias("points"))
    )


def hull_points(hulls: DataFrame) -> DataFrame:
    return hulls.select("image_id", F.posexplode("points").alias("pos", "p")).select("image_id", "pos", "p.x", "p.y")


def _first_gap(path: Column, gap: float) -> Column:
    """1-based place of the first step of `path` that is at least `gap` long; null without one."""
    def wide(i: Column) -> Column:
        p, q = F.element_at(path, i), F.element_at(path, i + 1)
        return distance2(p["x"], p["y"], q["x"], q["y"]) >= gap * gap

    steps = F.when(F.size(path) > 1, F.sequence(F.lit(1), F.size(path) - 1)).otherwise(F.array().cast("array<int>"))
    return F.get(F.filter(steps, wide), F.lit(0))


def canopy_ends(hulls: DataFrame, extremes: DataFrame, gap: float = 200.0, reach: int = 30) -> DataFrame:
    """Left and right end of the canopy.

    From the hull start walk over the first `reach` corners to the right end, the
    point before the first step of at least `gap`, and over the last `reach` corners
    backwards to the left end. Without such a step the end stays at the default. A
    walk that ends at the start puts both ends back to the default (of the second
    walk this holds for the right end too). Every step is an array expression: no
    exchange beyond the join with the extreme points.
    """
    d = hulls.join(extremes.hint("merge"), on="image_id")
    pts, n = F.col("points"), F.size("points")
    top = F.element_at(pts, 1)
    forward = F.slice(pts, F.lit(1), F.least(n, F.lit(reach)))
    backward = F.concat(F.array(top), F.slice(F.reverse(pts), F.lit(1), F.least(n, F.lit(reach))))
    d = d.select(
        "image_id", "left_x", "right_x", top.alias("top"), n.alias("n"), forward.alias("fw"), backward.alias("bw"),
        _first_gap(forward, gap).alias("fgap"), _first_gap(backward, gap).alias("bgap"),
    )
    stuck_fw = F.coalesce(F.col("fgap") == 1, F.size("fw") == 1)
    stuck_bw = F.coalesce(F.col("bgap") == 1, F.col("n") <= reach)
    low = whole(F.col("top.y") * F.lit(0.67))

    def end(is_default: Column, path: str, at: str, near: str, far: str) -> Column:
        default = F.struct(
            whole(F.col(near) * 5.0 / 8.0 + F.col(far) * 3.0 / 8.0).alias("x"), low.alias("y")
        )
        found = F.when(F.col(at).isNotNull(), F.element_at(F.col(path), F.col(at)))
        return F.when(is_default, default).otherwise(F.coalesce(found, default))

    return d.select(
        "image_id",
        F.col("top.x").alias("top_x"),
        F.col("top.y").alias("top_y"),
        end(stuck_bw, "bw", "bgap", "left_x", "right_x").alias("l"),
        end(stuck_fw | stuck_bw, "fw", "fgap", "right_x", "left_x").alias("r"),
    ).select(
        "image_id", "top_x", "top_y",
        F.col("l.x").alias("canopy_left_x"), F.col("l.y").alias("canopy_left_y"),
        F.col("r.x").alias("canopy_right_x"), F.col("r.y").alias("canopy_right_y"),
    )


def canopy_line(ends: DataFrame, *more: str) -> DataFrame:
    """Line of the canopy label: through the ends, or at the height of the top if they lie no higher; `more` columns are kept."""
    low = (F.col("canopy_left_y") + F.col("canopy_right_y")) * 0.5 >= F.col("top_y")
    return ends.select(
        "image_id",
        F.col("canopy_left_x").alias("x1"),
        F.when(low, F.col("top_y")).otherwise(F.col("canopy_left_y")).alias("y1"),
        F.col("canopy_right_x").alias("x2"),
        F.when(low, F.col("top_y")).otherwise(F.col("canopy_right_y")).alias("y2"),
        *more,
    )
