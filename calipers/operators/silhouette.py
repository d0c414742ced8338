"""Silhouette measures on a pixel table: pixels(image_id, x, y, r, g, b), y downwards.

Masks are kept as horizontal runs (image_id, y, x0, x1); all later steps work on
runs, which are far fewer than pixels.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from calipers.functions.shapes import whole
from calipers.operators.tiles import forest_runs, label_runs, pixel_runs, smooth_tiles
from calipers.runtime import settle

# Luminance weights of r, g, b (in 1/10000), and the 14-bit grey weights.
LUMINANCE = (2125, 7154, 721)
GREY_BITS = 14
GREY_RGB = (4899, 9617, 1868)
GREY_SWAPPED = (1868, 9617, 4899)  # contour route: red and blue weights exchanged
CONTOUR_THRESHOLD = 220
MIN_COMPONENT_SHARE = 0.002
MIN_OF_LARGEST = 0.15
FIRST_CUTOFF, LAST_CUTOFF = 95, 100  # percent of white
MIN_FOREGROUND_SHARE = 0.10
CROPPED_TOP = 5


def bordered_images(images: DataFrame, ratio: float) -> DataFrame:
    """Image sizes with a border on all sides; `border` is also the shift of every coordinate."""
    return images.withColumn("border", whole(F.greatest("img_w", "img_h") * F.lit(ratio))).select(
        "*",
        (F.col("img_w") + 2 * F.col("border")).alias("bordered_w"),
        (F.col("img_h") + 2 * F.col("border")).alias("bordered_h"),
    )


def luminance() -> Column:
    """Luminance times 2,550,000 as a whole number (white is 2,550,000)."""
    r, g, b = LUMINANCE
    return (F.col("r") * r + F.col("g") * g + F.col("b") * b).cast("long")


def grey(weights: tuple[int, int, int] = GREY_RGB) -> Column:
    """Grey value 0..255, rounded."""
    wr, wg, wb = weights
    total = F.col("r") * wr + F.col("g") * wg + F.col("b") * wb + 2 ** (GREY_BITS - 1)
    return F.shiftright(total.cast("long"), GREY_BITS)


def smoothed(pixels: DataFrame, weights: tuple[int, int, int] = GREY_SWAPPED) -> DataFrame:
    """(image_id, x, y, level): grey values after a 3x3 smoothing with weights 1 2 1 both ways."""
    total = smooth_tiles(pixels.select("image_id", "x", "y", grey(weights).alias("v")))
    return total.select("image_id", "x", "y", F.shiftright(F.col("v") + 8, 4).alias("level"))


def contour_mask(pixels: DataFrame, threshold: int = CONTOUR_THRESHOLD) -> DataFrame:
    return smoothed(pixels).where(F.col("level") <= threshold).select("image_id", "x", "y")


def luminance_mask(pixels: DataFrame, cutoff: int = FIRST_CUTOFF) -> DataFrame:
    """Pixels at most `cutoff` percent as bright as white."""
    return pixels.where(luminance() <= cutoff * 25_500).select("image_id", "x", "y")


def image_sizes(pixels: DataFrame) -> DataFrame:
    return pixels.groupBy("image_id").agg((F.max("x") + 1).alias("img_w"), (F.max("y") + 1).alias("img_h"))


def mask_runs(mask: DataFrame, *more: str) -> DataFrame:
    """Maximal horizontal runs of a mask: (image_id, y, x0, x1), apart for each value of `more`."""
    return pixel_runs(mask, *more)


def labelled_runs(mask: DataFrame) -> DataFrame:
    """Runs of a mask with the label of their component."""
    return label_runs(mask_runs(mask))


def component_areas(runs: DataFrame) -> DataFrame:
    """(image_id, label, area, top): pixels and first row of each component."""
    return runs.groupBy("image_id", "label").agg(
        F.sum(F.col("x1") - F.col("x0") + 1).cast("long").alias("area"), F.min("y").alias("top")
    )


def drop_specks(areas: DataFrame, sizes: DataFrame, share: float = MIN_COMPONENT_SHARE) -> DataFrame:
    """Components larger than `share` of their image."""
    return areas.join(sizes.hint("merge"), on="image_id").where(
        F.col("area") > F.col("img_w") * F.col("img_h") * F.lit(share)
    )


def keep_large(areas: DataFrame, share: float = MIN_OF_LARGEST) -> DataFrame:
    """Components of at least `share` of the largest one of their image."""
    largest = areas.groupBy("image_id").agg(F.max("area").alias("largest"))
    return areas.join(largest.hint("merge"), on="image_id").where(F.col("area") >= F.col("largest") * F.lit(share))


def largest_component(areas: DataFrame) -> DataFrame:
    """One component per image; equal areas: the one whose first pixel comes first."""
    best = areas.groupBy("image_id").agg(
        F.min(F.struct((-F.col("area")).alias("n"), F.col("label"), F.col("top"))).alias("best")
    )
    return best.select("image_id", "best.label", (-F.col("best.n")).alias("area"), "best.top")


def _entry_cutoff() -> Column:
    """The first cutoff at which a pixel is dark enough (95 to 100)."""
    percent = F.floor((luminance() + 25_499) / 25_500).cast("int")
    return F.greatest(percent, F.lit(FIRST_CUTOFF))


def adaptive_runs(
    pixels: DataFrame, sizes: DataFrame | None = None, speck_share: float = MIN_COMPONENT_SHARE
) -> DataFrame:
    """Labelled runs of the non-white silhouette, with the cutoff chosen for each image.

    The cutoff is the first one, from 95 % in steps of 1 %, whose components (without
    specks) cover more than a tenth of the image; at 100 % all pixels count. Pixels are
    read once and packed into runs that enter at the same cutoff; the components of all cutoffs come from
    one merge forest. `sizes` (image_id, img_w, img_h) gives the sizes of the images; without it an image is as
    large as its pixels reach, so it has to be given where white pixels have no rows.
    Columns: image_id, cutoff, y, x0, x1, label, area.
    """
    steps = list(range(FIRST_CUTOFF, LAST_CUTOFF))
    dark = pixels.select("image_id", "x", "y", _entry_cutoff().alias("level")).where(F.col("level") < LAST_CUTOFF)
    sizes = image_sizes(pixels) if sizes is None else sizes.select("image_id", "img_w", "img_h")
    pieces, whole = forest_runs(mask_runs(dark, "level"), steps)
    parts = pieces.select(
        "image_id", (F.col("x1") - F.col("x0") + 1).alias("length"), F.posexplode("labels").alias("k", "label")
    ).where("label is not null").groupBy("image_id", (F.col("k") + FIRST_CUTOFF).alias("cutoff"), "label").agg(
        F.sum("length").alias("area")
    )
    if whole is not None:
        parts = _whole(parts, whole).groupBy("image_id", "cutoff", "label").agg(F.sum("area").alias("area"))
    kept = settle(drop_specks(parts, sizes, speck_share))
    passed = (
        kept.groupBy("image_id", "img_w", "img_h", "cutoff").agg(F.sum("area").alias("covered"))
        .where(F.col("covered") > F.col("img_w") * F.col("img_h") * F.lit(MIN_FOREGROUND_SHARE))
        .groupBy("image_id").agg(F.min("cutoff").alias("cutoff"))
    )
    chosen = settle(sizes.join(passed.hint("merge"), on="image_id", how="left").fillna({"cutoff": LAST_CUTOFF}))
    labelled = pieces.join(chosen.where(F.col("cutoff") < LAST_CUTOFF).hint("merge"), on="image_id").select(
        "image_id", "cutoff", "y", "x0", "x1", F.get("labels", F.col("cutoff") - FIRST_CUTOFF).alias("label")
    ).where("label is not null")
    if whole is not None:
        labelled = _whole(labelled, whole)
    found = labelled.join(kept.select("image_id", "cutoff", "label", "area").hint("merge"), on=["image_id", "cutoff", "label"])
    everything = chosen.where(F.col("cutoff") == LAST_CUTOFF).select(
        "image_id",
        "cutoff",
        F.explode(F.sequence(F.lit(0), (F.col("img_h") - 1).cast("int"))).alias("y"),
        F.lit(0).alias("x0"),
        (F.col("img_w") - 1).cast("int").alias("x1"),
        F.lit(0).cast("long").alias("label"),
        (F.col("img_w") * F.col("img_h")).cast("long").alias("area"),
    )
    return found.select(everything.columns).unionByName(everything)


def _whole(parts: DataFrame, whole: DataFrame) -> DataFrame:
    """The labels of components that cross tile borders in place of those of their parts."""
    return parts.join(whole.hint("merge"), on=["image_id", "cutoff", "label"], how="left").withColumn(
        "label", F.coalesce("least", "label")
    ).drop("least")


def silhouette_boxes(runs: DataFrame) -> DataFrame:
    """Box of the large components, and (`_bb`) of all components, from labelled runs with areas.

    Components are boxed first, so the comparison with the largest one joins a few rows per image.
    """
    parts = runs.groupBy("image_id", "label").agg(
        F.max("area").alias("area"),
        F.min("x0").alias("min_x"), F.max("x1").alias("max_x"), F.min("y").alias("min_y"), F.max("y").alias("max_y"),
    )
    largest = parts.groupBy("image_id").agg(F.max("area").alias("largest"))
    big = F.col("area") >= F.col("largest") * F.lit(MIN_OF_LARGEST)
    names = ["min_x", "max_x", "min_y", "max_y"]
    least = {n: F.min if n.startswith("min") else F.max for n in names}
    return (
        parts.join(largest.hint("merge"), on="image_id")  # a row for each picture or part: never broadcast
        .groupBy("image_id")
        .agg(
            *[least[n](F.when(big, F.col(n))).alias(n) for n in names],
            *[least[n](n).alias(f"{n}_bb") for n in names],
        )
    )


def largest_shape_runs(mask: DataFrame) -> DataFrame:
    """Runs of the largest component of each image."""
    runs = labelled_runs(mask)
    best = largest_component(component_areas(runs)).select("image_id", "label")
    return runs.join(best.hint("merge"), on=["image_id", "label"]).select("image_id", "y", "x0", "x1")


def cropped_check(largest: DataFrame, limit: int = CROPPED_TOP) -> DataFrame:
    """`whole` unless the largest shape starts within the first rows; input has image_id, top."""
    verdict = F.when(F.col("top") <= limit, "cropped").otherwise("whole")
    return largest.select("image_id", "top", verdict.alias("verdict"))


def extreme_points(runs: DataFrame) -> DataFrame:
    """Leftmost, rightmost, topmost and bottom point of a shape; ties: the least other coordinate."""
    pt = lambda first, second: F.struct(first.alias("k"), second.alias("o"))
    y, x0, x1 = F.col("y"), F.col("x0"), F.col("x1")
    found = runs.groupBy("image_id").agg(
        F.min(pt(x0, y)).alias("left"),
        F.min(pt(-x1, y)).alias("right"),
        F.min(pt(y, x0)).alias("top"),
        F.min(pt(-y, x0)).alias("bottom"),
    )
    return found.select(
        "image_id",
        F.col("left.k").alias("left_x"), F.col("left.o").alias("left_y"),
        (-F.col("right.k")).alias("right_x"), F.col("right.o").alias("right_y"),
        F.col("top.o").alias("top_x"), F.col("top.k").alias("top_y"),
        F.col("bottom.o").alias("bottom_x"), (-F.col("bottom.k")).alias("bottom_y"),
    )
