"""Mixing sources to target weights with a time-varying curriculum, in DataFrame functions only.

Each source gets a target of words. Its share of training time follows a schedule whose
weight runs linearly from 1 - ramp at the start to 1 + ramp at the end; the integral of
the schedule is the source's cumulative demand. A document copy that stands at the share x
of its source's stream is read when the demand reaches x: the inverse of the integral. Rows
sorted by that position are the training order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from calipers.llm.common import text_of

#: A word: a run of anything but the six ASCII white space characters.
WORD = r"[^\x20\x09-\x0D]+"
#: Source tables up to so many rows are broadcast; longer ones are joined by shuffle.
SMALL_SOURCES = 100_000


def words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(
    sizes: DataFrame, weights: tuple[int, ...] = (1, 2, 3), ramps: tuple[float, ...] = (-0.5, 0.0, 0.5), most: int = 3
) -> DataFrame:
    """source, n, source_size -> the same with target and ramp; one row per source.

    Sources by code point, null last, take the weights (and ramps) in turn. The targets
    share the sum of all sizes by weight; a target stops at `most` times its source's
    size and the excess is shared again until none is above. That fixed point is a water
    level: with sources in the order of limit / weight, those that fill up come first.
    """
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    pick = lambda values, kind: F.element_at(
        F.array(*(F.lit(v).cast(kind) for v in values)), (F.col("rank") % len(values) + 1).cast("int")
    )
    weighed = sizes.withColumn("rank", rank).select(
        "source", "n", "source_size", "rank", pick(weights, "long").alias("weight"), pick(ramps, "double").alias("ramp"),
        (F.col("source_size") * most).alias("limit"),
    )
    by_level = Window.orderBy((F.col("limit") / F.col("weight")), "rank")
    ahead = by_level.rowsBetween(Window.unboundedPreceding, -1)
    rest = by_level.rowsBetween(0, Window.unboundedFollowing)
    everything = Window.partitionBy()
    levels = weighed.select(
        "*", F.sum("source_size").over(everything).alias("total"),
        F.coalesce(F.sum("limit").over(ahead), F.lit(0)).alias("full"), F.sum("weight").over(rest).alias("open"),
    ).withColumn("level", (F.col("total") - F.col("full")) / F.col("open"))
    fits = F.col("level") <= F.col("limit") / F.col("weight")
    chosen = levels.withColumn("chosen", F.min_by(
        F.when(fits, F.struct((F.col("total") - F.col("full")).alias("left"), "open")),
        F.when(fits, F.struct(F.col("limit") / F.col("weight"), F.col("rank"))),
    ).over(everything))
    share = F.col("chosen.left") * F.col("weight") / F.col("chosen.open")
    return chosen.select(
        "source", "n", "source_size", "ramp",
        F.coalesce(F.least(share, F.col("limit").cast("double")), F.lit(0.0)).alias("target"),
    )


def demand_time(share: Column, ramp: Column) -> Column:
    """The time in [0, 1] at which the integral of 1 - ramp + 2 ramp t reaches `share` of the whole."""
    flat = F.abs(ramp) < 1e-9
    root = F.sqrt(F.greatest((1 - ramp) * (1 - ramp) + 4 * ramp * share, F.lit(0.0)))
    return F.when(flat, share).otherwise((root - (1 - ramp)) / F.when(flat, F.lit(1.0)).otherwise(2 * ramp))


def takes(
    docs: DataFrame, rows_per_piece: int = 2_000, most: int = 3, keep: list[str] | None = None, **shape: tuple
) -> DataFrame:
    """`row`, size, source_size, target, copies, taken and positions (one for each copy) of every document.

    `row` has the columns of docs, or those named by `keep`: what is left out is not shuffled.

    A source is passed through whole as often as its target allows; the last pass takes
    the documents, in an order drawn from their ids, whose middle lies before the target.
    So the words taken differ from the target by half a document at most, and no document
    is taken more than `most` times. Places in a source come from two levels of running
    sums: over slices of about `rows_per_piece` rows, and inside a slice. A source that
    holds most rows has many slices, so no task gets a source.

    Null or empty text: size 0, taken with 0 words. Null source: a source of its own.
    Null doc_id: an order key like any other. Repeated rows: each has its own place.
    No rows: no rows.
    """
    base = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in (docs.columns if keep is None else keep)]).alias("row"),
        words(F.col("text").cast("string")).alias("size"), F.col("source").cast("string").alias("source"),
        F.crc32(text_of(F.col("text")).cast("binary")).alias("tie"), F.col("doc_id").cast("long").alias("id"),
    ).withColumn("draw", F.conv(F.substring(F.md5(
        F.coalesce(F.col("id").cast("string"), F.lit("")).cast("binary")
    ), 1, 12), 16, 10).cast("long"))
    sizes = base.groupBy("source").agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("source_size"))
    sources = source_targets(sizes, most=most, **shape)
    if sources.count() <= SMALL_SOURCES:
        sources = F.broadcast(sources)
    joined = base.alias("b").join(sources.alias("s"), F.col("b.source").eqNullSafe(F.col("s.source"))).select(
        "row", "size", "tie", "id", "draw", "source_size", "target", "ramp",
        F.coalesce(F.concat(F.lit("s"), F.col("b.source")), F.lit("n")).alias("key"),
        F.floor(F.col("draw") / F.lit(2.0**48) * F.ceil(F.col("n") / rows_per_piece)).cast("long").alias("piece"),
    )
    piece_sums = joined.groupBy("key", "piece").agg(F.sum("size").alias("piece_size"))
    before = piece_sums.select("key", "piece", (
        F.sum("piece_size").over(Window.partitionBy("key").orderBy("piece")) - F.col("piece_size")
    ).alias("before"))
    inside = Window.partitionBy("key", "piece").orderBy("draw", "id", "tie", "size").rowsBetween(
        Window.unboundedPreceding, 0
    )
    placed = joined.join(before, ["key", "piece"]).withColumn(
        "start", F.col("before") + F.sum("size").over(inside) - F.col("size")
    )
    passes = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    middle = F.col("start") + F.col("size") / 2
    counted = placed.withColumn("passes", passes.cast("int")).withColumn(
        "copies",
        (F.col("passes") + (middle < F.col("target") - F.col("passes") * F.col("source_size")).cast("int")).cast("int"),
    )
    position = lambda copy: demand_time(
        F.least((copy * F.col("source_size") + middle) / F.col("target"), F.lit(1.0)), F.col("ramp")
    )
    return counted.select(
        "row", "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken"),
        F.when(
            (F.col("copies") > 0) & (F.col("target") > 0), F.transform(F.sequence(F.lit(0), F.col("copies") - 1), position)
        ).otherwise(F.array().cast("array<double>")).alias("positions"),
    )


def mix_rows(docs: DataFrame) -> DataFrame:
    """The digest of `takes`, one row per document, range-sorted by the first position (untaken ones first)."""
    found = takes(docs, keep=["doc_id"]).select(
        F.col("row.doc_id").alias("doc_id"), "size", "source_size", "target", "taken", "copies",
        F.round(F.try_element_at("positions", F.lit(1)), 9).alias("position"),
    )
    return found.repartitionByRange("position", "doc_id").sortWithinPartitions("position", "doc_id")


def training_order(docs: DataFrame) -> DataFrame:
    """The columns of docs, each document as often as it is taken, range-sorted by training position."""
    copies = takes(docs).select("row", F.explode("positions").alias("position"))
    return copies.repartitionByRange("position", F.col("row.doc_id")).sortWithinPartitions(
        "position", F.col("row.doc_id")
    ).select("row.*")
