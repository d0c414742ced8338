"""Line segments -> edges. segments(image_id, seg_id, x1, y1, x2, y2), seg_id giving their order."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from calipers.functions.shapes import (
    DISTANCE_LIMIT,
    PARALLEL_LIMIT,
    distance,
    distance2,
    line_to_segment,
    near_parallel,
)
from calipers.operators.components import pointer_roots
from calipers.operators.tiles import whole_groups
from calipers.runtime import settle, ship

ANGLE_CELLS = 45  # cells per half turn: 4 degrees each
OFFSET_CELL = 128.0  # pixels
#: Earlier segments that a sweep takes at a time, and later ones that are compared with them at once.
EARLIER, LATER = 256, 4096
#: Segments of a picture that is not cut into cells.
FEW = 64
#: What a segment is in a cell: one that looks for earlier ones, one that is looked for, or both.
LATER_ONE, EARLIER_ONE, BOTH = 1, 0, 2


def with_angle(segments: DataFrame) -> DataFrame:
    return segments.withColumn("theta", F.atan2(F.col("y2") - F.col("y1"), F.col("x2") - F.col("x1")))


def _offset(angle: Column, x: Column, y: Column) -> Column:
    return F.cos(angle) * y - F.sin(angle) * x


def _line_cells(segments: DataFrame) -> DataFrame:
    """The one (angle, offset) cell of the line through each segment."""
    width = math.pi / ANGLE_CELLS
    half = F.when(F.col("theta") < 0, F.col("theta") + math.pi).otherwise(F.col("theta"))
    half = F.when(half >= math.pi, half - math.pi).otherwise(half)
    return (
        segments.withColumn("half", half)
        .withColumn("angle_cell", F.least(F.floor(F.col("half") / width), F.lit(ANGLE_CELLS - 1)).cast("int"))
        .withColumn("offset_cell", F.floor(_offset(F.col("half"), F.col("x1"), F.col("y1")) / OFFSET_CELL))
    )


def _reach_cells(segments: DataFrame, theta_limit: float, dist_limit: float) -> DataFrame:
    """All cells whose lines may be similar to the segment.

    A line is near enough only if it runs within `dist_limit` of an end or between
    the ends, so its offset lies between the ends' offsets, widened by that limit and
    by what a turn of half a cell changes (at most |point| * half cell).
    """
    width = math.pi / ANGLE_CELLS
    lo, hi = F.col("theta") - theta_limit - 1e-6, F.col("theta") + theta_limit + 1e-6
    d = segments.withColumn(
        "k", F.explode(F.sequence(F.floor(lo / width).cast("int"), F.floor(hi / width).cast("int")))
    ).withColumn("mid", (F.col("k") + 0.5) * width)
    o1 = _offset(F.col("mid"), F.col("x1"), F.col("y1"))
    o2 = _offset(F.col("mid"), F.col("x2"), F.col("y2"))
    norm = F.greatest(*[F.abs(c) for c in ("x1", "y1", "x2", "y2")]) * math.sqrt(2)
    slack = norm * (width / 2) + dist_limit + 1
    d = d.withColumn("lo", F.least(o1, o2) - slack).withColumn("hi", F.greatest(o1, o2) + slack)
    # a line turned by half a turn is the same line with the other sign
    flipped = F.pmod(F.floor(F.col("k") / ANGLE_CELLS), F.lit(2)) == 1
    first = F.when(flipped, -F.col("hi")).otherwise(F.col("lo"))
    last = F.when(flipped, -F.col("lo")).otherwise(F.col("hi"))
    return d.withColumn("angle_cell", F.pmod("k", F.lit(ANGLE_CELLS))).withColumn(
        "offset_cell", F.explode(F.sequence(F.floor(first / OFFSET_CELL), F.floor(last / OFFSET_CELL)))
    )


def similar_segments(
    segments: DataFrame, theta_limit: float = PARALLEL_LIMIT, dist_limit: float = DISTANCE_LIMIT
) -> DataFrame:
    """Pairs (image_id, seg_i, seg_j), seg_i > seg_j, that belong to one edge.

    Similar: nearly parallel, and either line passes closer than `dist_limit` to both
    ends of the other segment or between them. A segment without length is similar to none. Lines are points in (angle, offset)
    space; each earlier segment looks only into the cells that can hold a similar
    line, so a picture with very many segments is spread over its cells instead of
    being compared pair by pair. Each pair meets in exactly one cell.
    """
    base = with_angle(segments).select("image_id", "seg_id", "x1", "y1", "x2", "y2", "theta")
    cells = ["image_id", "angle_cell", "offset_cell"]
    later, earlier = _line_cells(base).alias("i"), _reach_cells(base, theta_limit, dist_limit).alias("j")
    on = [F.col(f"i.{c}") == F.col(f"j.{c}") for c in cells]
    similar = (
        near_parallel(F.col("i.theta"), F.col("j.theta"), theta_limit)
        & (line_to_segment("i", "j") < dist_limit) & (line_to_segment("j", "i") < dist_limit)
    )
    return (
        later.join(earlier, on=on)
        .where(F.col("i.seg_id") > F.col("j.seg_id"))
        .where(similar)
        .select("i.image_id", F.col("i.seg_id").alias("seg_i"), F.col("j.seg_id").alias("seg_j"))
    )


def _similar(i: np.ndarray, j: np.ndarray, theta_limit: float, dist_limit: float) -> np.ndarray:
    """The rule of `similar_segments` on rows (x1, y1, x2, y2, theta) along the last axis."""
    def off(line: np.ndarray, seg: np.ndarray) -> np.ndarray:
        dx, dy = line[..., 2] - line[..., 0], line[..., 3] - line[..., 1]
        length = np.sqrt(dx * dx + dy * dy)
        one, two = (
            (dx * (seg[..., k + 1] - line[..., 1]) - dy * (seg[..., k] - line[..., 0])) / length for k in (0, 2)
        )
        return np.where(one * two <= 0, 0.0, np.maximum(np.abs(one), np.abs(two)))

    with np.errstate(all="ignore"):  # no length: NaN, which is similar to nothing
        gap = i[..., 4] - j[..., 4]
        turn = np.minimum(np.abs(gap), np.minimum(np.abs(gap + math.pi), np.abs(gap - math.pi)))
        return (turn < theta_limit) & (off(i, j) < dist_limit) & (off(j, i) < dist_limit)


def _sweep(
    seg: np.ndarray, place: np.ndarray, later: np.ndarray, earlier: np.ndarray, theta_limit: float, dist_limit: float
) -> np.ndarray:
    """For each of the rows `later`, the first of the rows `earlier` it is similar to, or -1; both ascend.

    The earlier rows are taken a few at a time, and a row that has found its first one is done: a cell of
    segments on one line takes one step.
    """
    first = np.full(len(later), -1, dtype=np.int64)
    for begin in range(0, len(earlier), EARLIER):
        some = earlier[begin: begin + EARLIER]
        open_ = np.flatnonzero((first < 0) & (seg[later] > seg[some[0]]))
        for part in np.array_split(open_, max(1, len(open_) // LATER)):
            rows = later[part]
            hit = _similar(place[rows][:, None], place[some][None, :], theta_limit, dist_limit)
            hit &= seg[rows][:, None] > seg[some][None, :]
            found = hit.any(axis=1)
            first[part[found]] = some[hit[found].argmax(axis=1)]
    return first


def _firsts(
    cell: np.ndarray, is_later: np.ndarray, seg: np.ndarray, place: np.ndarray, theta_limit: float, dist_limit: float
) -> tuple[np.ndarray, np.ndarray]:
    """Rows of later segments and the row of the first earlier one each is similar to; rows by cell, then segment."""
    later, earlier = np.flatnonzero(is_later), np.flatnonzero(~is_later)
    cells = int(cell[-1]) + 1
    n_later, n_earlier = np.bincount(cell[later], minlength=cells), np.bincount(cell[earlier], minlength=cells)
    at_later, at_earlier = np.cumsum(n_later) - n_later, np.cumsum(n_earlier) - n_earlier
    small = n_later * n_earlier <= EARLIER * EARLIER
    rows, first = [later[:0]], [later[:0]]
    own = later[small[cell[later]]]
    times = n_earlier[cell[own]]
    for a, b in _bounded(times, LATER * EARLIER):
        i = np.repeat(own[a:b], times[a:b])
        offset = np.arange(len(i)) - np.repeat(np.cumsum(times[a:b]) - times[a:b], times[a:b])
        j = earlier[at_earlier[cell[i]] + offset]
        hit = np.flatnonzero((seg[i] > seg[j]) & _similar(place[i], place[j], theta_limit, dist_limit))
        found, at = np.unique(i[hit], return_index=True)
        rows.append(found)
        first.append(j[hit[at]])
    for c in np.flatnonzero(~small):
        mine = later[at_later[c]: at_later[c] + n_later[c]]
        found = _sweep(seg, place, mine, earlier[at_earlier[c]: at_earlier[c] + n_earlier[c]], theta_limit, dist_limit)
        rows.append(mine[found >= 0])
        first.append(found[found >= 0])
    return np.concatenate(rows), np.concatenate(first)


def _bounded(sizes: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Bounds of stretches of about `most` in total."""
    ends = np.cumsum(sizes)
    begin = 0
    while begin < len(sizes):
        done = ends[begin - 1] if begin else 0
        end = max(begin + 1, int(np.searchsorted(ends, done + most, side="right")))
        yield begin, end
        begin = end


def first_similar(
    segments: DataFrame, theta_limit: float = PARALLEL_LIMIT, dist_limit: float = DISTANCE_LIMIT, held: str | None = None
) -> DataFrame:
    """(image_id, seg_id, first): the first earlier segment that each segment is similar to, where there is one.

    The same as the least seg_j in `similar_segments`, without its pairs: in every cell the later segments sweep over
    the earlier ones in order, and each stops at the first that is similar. Where the column `held` tells how many segments
    a picture has, one of few is one cell, so that its segments are not sent to all the cells they reach.
    """
    ship(segments.sparkSession)
    base = with_angle(segments).select(
        "image_id", "seg_id", *(F.col(c).cast("double").alias(c) for c in ("x1", "y1", "x2", "y2", "theta")),
        (F.col(held) if held else F.lit(None).cast("long")).alias("held"),
    )
    cells = ["image_id", "angle_cell", "offset_cell"]
    columns = [*cells, "seg_id", "later", "x1", "y1", "x2", "y2", "theta"]
    small = F.coalesce(F.col("held") <= FEW, F.lit(False))
    many = base.where(~small)
    one = {"angle_cell": F.lit(0), "offset_cell": F.lit(0).cast("long")}
    few = base.where(small).withColumns(one).withColumn("later", F.lit(BOTH))
    both = few.select(columns).unionByName(_line_cells(many).withColumn("later", F.lit(LATER_ONE)).select(columns)).unionByName(
        _reach_cells(many, theta_limit, dist_limit).withColumn("later", F.lit(EARLIER_ONE)).select(columns)
    )
    kinds = {f.name: f.dataType.simpleString() for f in segments.schema.fields}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, cell in whole_groups(batches, cells):
            seg, later = rows.column("seg_id").to_numpy(), rows.column("later").to_numpy()
            place = np.stack([rows.column(c).to_numpy() for c in ("x1", "y1", "x2", "y2", "theta")], axis=1)
            # a segment of a picture of one cell comes once and stands on both sides
            of = np.repeat(np.arange(len(seg)), np.where(later == BOTH, 2, 1))
            is_later = np.append(of[1:] == of[:-1], False) | (later[of] == LATER_ONE)
            own, first = _firsts(cell[of], is_later, seg[of], place[of], theta_limit, dist_limit)
            if len(own):
                found = rows.select(["image_id", "seg_id"]).take(pa.array(of[own]))
                yield from found.append_column("first", rows.column("seg_id").take(pa.array(of[first]))).combine_chunks().to_batches()

    return both.repartition(*cells).sortWithinPartitions(*cells, "seg_id").mapInArrow(
        run, f"image_id {kinds['image_id']}, seg_id {kinds['seg_id']}, first {kinds['seg_id']}"
    )


def segment_groups(segments: DataFrame) -> DataFrame:
    """(image_id, seg_id, edge_id): every segment joins the group of the first earlier one it is similar to.

    This is not the transitive closure: only the earliest similar segment counts.
    edge_id is the segment that opened the group.
    """
    # both sides have about a row for each segment, which Spark's guess behind explode or Python misses: never broadcast
    sizes = segments.groupBy("image_id").agg(F.count(F.lit(1)).alias("held"))
    firsts = first_similar(segments.hint("merge").join(sizes, on="image_id"), held="held")
    parents = segments.hint("merge").join(firsts, on=["image_id", "seg_id"], how="left").select(
        "image_id", F.col("seg_id").alias("node"), F.coalesce("first", "seg_id").alias("parent")
    )
    return pointer_roots(parents, "image_id").select(
        "image_id", F.col("node").alias("seg_id"), F.col("root").alias("edge_id")
    )


def edge_endpoints(segments: DataFrame, groups: DataFrame) -> DataFrame:
    """One row per edge: its two ends and, for each end, the segment it comes from.

    The mean of the first points of the segments gives the first end (the farthest
    segment end), the point half way between both gives the second one. Ties: the
    lower segment, then its first end. All steps group by (image_id, edge_id).
    """
    key = ["image_id", "edge_id"]
    members = settle(segments.hint("merge").join(groups, on=["image_id", "seg_id"]).select(*key, "seg_id", "x1", "y1", "x2", "y2"))
    mean = members.groupBy(*key).agg(F.avg("x1").alias("mx"), F.avg("y1").alias("my"))
    dealt = members.repartition(*key)  # both searches read this exchange, and ends are made behind it

    def farthest(refs: DataFrame, name: str) -> DataFrame:
        d2 = distance2(F.col("px"), F.col("py"), F.col("x"), F.col("y"))
        far = F.min(F.struct((-d2).alias("n"), "seg_id", "side", "x", "y", "seg"))
        ends = dealt.join(refs.hint("merge"), on=key).select(
            *key, "seg_id", "px", "py", F.struct("x1", "y1", "x2", "y2").alias("seg"),
            F.inline(F.array(
                F.struct(F.lit(1).alias("side"), F.col("x1").alias("x"), F.col("y1").alias("y")),
                F.struct(F.lit(2).alias("side"), F.col("x2").alias("x"), F.col("y2").alias("y")),
            )),
        )
        return ends.groupBy(*key).agg(far.alias(name))

    one = farthest(mean.select(*key, F.col("mx").alias("px"), F.col("my").alias("py")), "e1")
    half = one.join(mean.hint("merge"), on=key).select(
        *key, ((F.col("e1.x") + F.col("mx")) / 2).alias("px"), ((F.col("e1.y") + F.col("my")) / 2).alias("py")
    )
    both = one.join(farthest(half, "e2").hint("merge"), on=key)
    ex1, ey1, ex2, ey2 = F.col("e1.x"), F.col("e1.y"), F.col("e2.x"), F.col("e2.y")
    return both.select(
        *key,
        ex1.alias("ex1"), ey1.alias("ey1"), ex2.alias("ex2"), ey2.alias("ey2"),
        distance(ex1, ey1, ex2, ey2).alias("length"),
        F.atan2(ey2 - ey1, ex2 - ex1).alias("theta"),
        F.col("e1.seg").alias("seg1"),
        F.col("e2.seg").alias("seg2"),
    )


def edges_of(segments: DataFrame) -> DataFrame:
    """Segments -> edges. They are read by several steps, so they are settled once."""
    segments = settle(segments)
    return edge_endpoints(segments, segment_groups(segments))
