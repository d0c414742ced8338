"""Composite jobs: the entry points of a user of the package."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from calipers.functions.shapes import whole
from calipers.functions.text import dimension_value, inches_label, rug_size
from calipers.operators import attributes as A
from calipers.operators import corners as C
from calipers.operators import exports as X
from calipers.operators import hull as H
from calipers.operators import layout as L
from calipers.operators import rings as R
from calipers.operators import segments as S
from calipers.operators import silhouette as I
from calipers.runtime import only, release
from calipers.sources import feeds


def dimension_lookup(
    images: DataFrame, feed: DataFrame, config: Mapping[str, Mapping[str, str]], places: int = 2
) -> DataFrame:
    """Dimension texts of every pictured item, their numbers and label texts."""
    used = sorted({guid for dims in config.values() for guid in dims.values()})
    wide = A.pivot_dimensions(A.dimension_attributes(images, config), feed, used)
    wide = wide.withColumns({f"{d}_in": dimension_value(F.col(d), places) for d in A.DIMENSIONS})
    return wide.withColumns({f"{d}_text": inches_label(F.col(f"{d}_in"), places) for d in A.DIMENSIONS})


def dimension_job(
    images: DataFrame, feed_folder: str, config: Mapping[str, Mapping[str, str]], start: dt.date, out_folder: str,
    max_retries: int = 30,
) -> tuple[dt.date, str]:
    """From the feed to the written dimension table: the look-back day is found, its dimensions are looked up and stored.

    Gives the day that was read and the folder that was written, which is named by `start`. No day within the look-back is an error, and
    so is a folder that exists.
    """
    feed = feeds.read_lookback(images.sparkSession, feed_folder, start, max_retries)
    if feed is None:
        raise LookupError(f"no day with data in the {max_retries + 1} days up to {start} below {feed_folder}")
    day = feed.select("snapshot_date").first()[0]
    found = dimension_lookup(images, feed.drop("snapshot_date"), config)
    return day, feeds.write_dimensions(found, out_folder, start)


def collection_dimensions(
    feed: DataFrame, items: DataFrame, dictionary: DataFrame, values: Sequence[str], columns: Mapping[str, str]
) -> DataFrame:
    """Items of a collection that have every dimension, with each of their product images."""
    chosen = A.items_with_values(feed, items, values)
    dims = A.attribute_product(feed, columns).join(chosen, on="oms_id", how="left_semi")
    pictures = A.values_by_name(feed, dictionary, "product image", "image_guid")
    return pictures.join(dims, on="oms_id")


def front_items(
    predictions: DataFrame, items: DataFrame, feed: DataFrame, columns: Mapping[str, str], style_id: str,
    like: Sequence[str], unlike: Sequence[str], view: str = "front", top: int = 10,
) -> DataFrame:
    """Items with a picture of the view, in the taxonomy, of one of the most frequent styles."""
    catalogue = items.select("oms_id", "taxonomy")
    for pattern in like:
        catalogue = catalogue.where(F.lower("taxonomy").like(pattern))
    for pattern in unlike:
        catalogue = catalogue.where(~F.lower("taxonomy").like(pattern))
    seen = predictions.where(F.col("prediction_labels").like(f"%{view}%")).select(
        F.col("oms_id").try_cast("string").alias("oms_id")
    )
    wanted = catalogue.join(seen, on="oms_id", how="left_semi").distinct()
    styles = A.in_top_styles(feed, style_id, top)
    return wanted.join(A.attribute_product(feed, columns), on="oms_id").join(styles, on="oms_id").distinct()


def rug_dimensions(rugs: DataFrame, feed: DataFrame, thickness: Sequence[str], image_id: str) -> DataFrame:
    """Rugs (numeric key) that have both thickness attributes and an image, with size from the name."""
    columns = {f"thickness_{k}": a for k, a in enumerate(thickness, 1)} | {"image_guid": image_id}
    named = A.with_text_key(rugs, "omsid").withColumn("size", rug_size(F.col("product_name")))
    return named.join(A.attribute_product(feed, columns), on="oms_id").select(
        "oms_id", "product_name", *columns, F.col("size.width").alias("width_in"),
        F.col("size.height").alias("height_in"),
        F.col(f"thickness_{len(thickness)}").try_cast("double").alias("depth_in"),
    )


def boxes_with_border(boxes: DataFrame, config: L.DrawingConfig) -> DataFrame:
    """Boxes measured on the bare picture, moved into the bordered one, with all line sizes."""
    moved = L.line_specs(I.bordered_images(boxes, config.border_ratio), config)
    names = [f"{m}_{a}{s}" for s in ("", "_bb") for a in "xy" for m in ("min", "max")]
    return moved.withColumns({n: F.col(n) + F.col("border") for n in names})


def measured_boxes(
    pixels: DataFrame, images: DataFrame, speck_share: float = I.MIN_COMPONENT_SHARE
) -> DataFrame:
    """`images` (image_id, img_w, img_h and any more) with the boxes of their silhouettes, measured on the pixels.

    Pixels are shuffled once, for their runs; boxes are reduced where the runs are, and the runs are removed then. An image
    without a pixel that is dark enough is measured whole.
    """
    boxes = only(lambda: I.silhouette_boxes(I.adaptive_runs(pixels, images, speck_share)))
    return boxes.join(images.hint("merge"), on="image_id")


def measured_plan(
    pixels: DataFrame, images: DataFrame, segments: DataFrame, side_images: DataFrame, views: DataFrame, dims: DataFrame,
    config: L.DrawingConfig, speck_share: float = I.MIN_COMPONENT_SHARE,
) -> DataFrame:
    """From pixels to the annotation plan in one lineage: boxes, border, front lines, side lines where they apply, labels.

    `images`: image_id, oms_id, product_type, img_w, img_h of the front pictures; `segments` and `side_images`
    are those of `side_layouts`, with image_id the item's number; `views`: oms_id, image_type; `dims` has <dim>_in.
    """
    boxes = boxes_with_border(measured_boxes(pixels, images, speck_share).drop("image_id"), config)
    side = side_layouts(segments, side_images).withColumn("oms_id", F.col("image_id").cast("string")).drop("image_id")
    modes = layout_by_mode(L.front_layout(boxes, config).join(views.hint("merge"), on="oms_id"), side, config)
    return annotation_plan(modes, dims, config)


def side_layouts(segments: DataFrame, images: DataFrame) -> DataFrame:
    """Segments of side pictures -> dimension lines: group, order, filter, match, name.

    A row for each picture is what is left on disk in the end.
    """
    def made() -> DataFrame:
        edges = only(lambda: S.edges_of(segments))
        kept = only(lambda: R.ring_filter(edges, R.ring_order(edges)).select(edges.columns))
        release(edges)
        return C.side_layout(C.corner_points(kept, C.match_corners(kept), images), images)

    return only(made)


LINES = ["height", "width", "depth", "center_x", "center_y"]


def layout_by_mode(
    front: DataFrame, side: DataFrame, config: L.DrawingConfig, to_front: bool = True
) -> DataFrame:
    """One layout per picture: the side one for pictures labelled SIDE, unless it shows the front.

    `front`: oms_id, image_type, border and front layout, in the bordered picture; `side`:
    oms_id and side layout with status, in the bare picture. Side lines are moved by the
    border, so all lines of the result are in the bordered picture. A side picture whose
    corners were not found fails, as does one without segments.
    """
    def bordered(line: str) -> Column:
        if line.startswith("center"):
            return F.col(f"side_{line}") + F.col("border")
        return F.struct(*[(F.col(f"side_{line}.{k}") + F.col("border")).alias(k) for k in ("x1", "y1", "x2", "y2")])


    flagged = side.select(
        "oms_id", L.is_really_front(config).alias("fronted"), F.col("status").alias("side_status"),
        *[F.col(c).alias(f"side_{c}") for c in LINES],
    )
    d = front.join(flagged.hint("merge"), on="oms_id", how="left")  # a row for each picture: never broadcast
    is_side = F.col("image_type") == "SIDE"
    back = F.coalesce(F.col("fronted"), F.lit(False)) & F.lit(to_front)
    mode = F.when(is_side & ~back, "SIDE").otherwise("FRONT")
    failed = is_side & (F.coalesce("side_status", F.lit("failed")) != "ok")
    d = d.withColumns({"mode": mode, "status": F.when(failed, "failed").otherwise("ok")})
    use_side = F.col("mode") == "SIDE"
    return d.withColumns(
        {c: F.when(use_side, bordered(c)).otherwise(F.col(c)) for c in LINES}
    ).drop("fronted", "side_status", *[f"side_{c}" for c in LINES])


def _drawn(name: str, config: L.DrawingConfig, rug: bool) -> Column:
    """What is drawn for one dimension: the line, the white box, where and how the text stands, the caps of a rug bar.

    The depth text stands left-aligned beside its line, without a box; others in the middle of their box.
    """
    at = L.shifted(f"{name}_label")
    box = {k: F.lit(None).cast("double") if name == "depth" else at[k] for k in ("bx1", "by1", "bx2", "by2")}
    point = L.depth_text_point(at, config) if name == "depth" else F.struct(
        ((at["bx1"] + at["bx2"]) / 2.0).alias("x"), ((at["by1"] + at["by2"]) / 2.0).alias("y")
    )
    caps = [L.end_caps(at, F.lit(name), config).alias("caps")] if rug else []
    return F.struct(
        F.lit(name).alias("dim_name"), F.col(f"{name}_text").alias("label"),
        F.struct(*[at[k].alias(k) for k in ("x1", "y1", "x2", "y2")], *[v.alias(k) for k, v in box.items()]).alias("at"),
        point["x"].alias("text_x"), point["y"].alias("text_y"),
        F.lit("left" if name == "depth" else "center").alias("text_align"), *caps,
    )


def annotation_plan(
    layouts: DataFrame, dims: DataFrame, config: L.DrawingConfig, rug: bool = False
) -> DataFrame:
    """Everything a renderer needs, one row per item and dimension, and the status of each item.

    `layouts` comes from `layout_by_mode` (or, for rugs, from the rug layout with mode and
    status); `dims` has <dim>_in. All coordinates are in the final canvas. Items without
    all dimensions, lines or distinct line ends are kept with a reason. With `rug` the
    texts are those of rugs, and the lines have end caps.
    """
    texts = L.label_texts(dims.select("oms_id", *[f"{d}_in" for d in L.ORDER]), config, rug)
    d = layouts.join(texts.hint("merge"), on="oms_id", how="left")  # a row for each item: never broadcast
    may_swap = (F.col("image_type") == "FRONT") & F.col("product_type").isin(list(config.swap_types))
    swap = may_swap & L.should_swap(config, F.col("width_in"), F.col("height_in"), F.col("depth_in"))
    d = L.swap_height_depth(d, F.coalesce(swap, F.lit(False)))
    d = d.withColumns({"canvas_w": F.col("bordered_w"), "canvas_h": F.col("bordered_h")})
    d = L.annotate(d, config)
    no_dims = F.greatest(*[F.col(f"{n}_text").isNull() for n in L.ORDER])
    no_label = F.greatest(*[F.col(f"{n}_label").isNull() for n in L.ORDER])
    reason = (
        F.when(F.col("status") != "ok", "no corners").when(no_dims, "no dimensions").when(no_label, "empty line")
    )
    d = d.withColumn("reason", reason)
    rows = F.array(*[_drawn(n, config, rug) for n in L.ORDER])
    return d.select(
        "oms_id", "product_type", "mode", "swapped", "canvas_w", "canvas_h", "line_width", "font_size",
        F.when(F.col("reason").isNull(), "ok").otherwise("failed").alias("status"), "reason", F.inline(rows),
    )


def rug_plan(boxes: DataFrame, rugs: DataFrame, config: L.DrawingConfig) -> DataFrame:
    """The annotation plan of rugs: front views with a horizontal depth bar; `rugs` comes from `rug_dimensions`.

    Several thicknesses or images of a rug do not matter here, the least thickness counts.
    """
    dims = rugs.groupBy("oms_id").agg(*[F.min(f"{n}_in").alias(f"{n}_in") for n in L.ORDER])
    layouts = L.front_layout(boxes_with_border(boxes, config), config, rug=True).join(
        dims.select("oms_id"), on="oms_id", how="left_semi"
    )
    fixed = {"image_type": F.lit("FRONT"), "mode": F.lit("FRONT"), "status": F.lit("ok")}
    return annotation_plan(layouts.withColumns(fixed), dims, config, rug=True)


def canopy_labels(
    hulls: DataFrame, extremes: DataFrame, images: DataFrame, config: L.DrawingConfig,
    away: tuple[float, float] = (500.0, 500.0), gap: float = 200.0, reach: int = 30,
) -> DataFrame:
    """Label above the canopy; `images`: image_id, img_w, img_h, canopy_in. No border before."""
    line = H.canopy_line(H.canopy_ends(hulls, extremes, gap, reach))
    bare = images.withColumns({"bordered_w": F.col("img_w"), "bordered_h": F.col("img_h")})
    d = line.join(L.line_specs(bare, config).hint("merge"), on="image_id").select(
        "image_id", "font_size", "line_margin", whole(F.col("line_width") * 1.5).alias("line_width"),
        F.col("img_w").cast("long").alias("canvas_w"), F.col("img_h").cast("long").alias("canvas_h"),
        F.struct(*[F.col(k).cast("double").alias(k) for k in ("x1", "y1", "x2", "y2")]).alias("canopy"),
        inches_label(F.col("canopy_in"), config.num_dim_decimal_pts).alias("label"),
    )
    size = F.col("font_size")
    placed = L.placed_label(
        "canopy", F.lit(away[0]), F.lit(away[1]), L.text_width(F.col("label"), size),
        L.text_height(F.col("label"), size), F.col("line_margin"), config,
    )
    return L.grown_canvas(d.withColumn("at", placed), ["at"], config)


def run_report(
    items: DataFrame, dims: DataFrame, images: DataFrame, listing: DataFrame, plan: DataFrame
) -> DataFrame:
    """Counts per product type: items, with all dimensions, without pictures, failed, swapped."""
    gone = X.missing_images(images, listing)
    readable = images.select("oms_id", "image_guid").distinct().join(gone, on="image_guid", how="left_anti")
    pictured = readable.select("oms_id").distinct().withColumn("pictured", F.lit(1))
    complete = dims.select(
        "oms_id", F.when(F.greatest(*[F.col(d).isNull() for d in A.DIMENSIONS]), 0).otherwise(1).alias("complete")
    )
    state = plan.groupBy("oms_id").agg(
        F.max(F.when(F.col("status") != "ok", 1).otherwise(0)).alias("failed"),
        F.max(F.when(F.col("swapped"), 1).otherwise(0)).alias("swapped"),
    )
    rows = (
        items.select("oms_id", "product_type")
        .join(complete, on="oms_id", how="left")
        .join(pictured, on="oms_id", how="left")
        .join(state, on="oms_id", how="left")
    )

    def total(c: Column, name: str) -> Column:
        return F.sum(F.coalesce(c, F.lit(0))).cast("long").alias(name)

    return rows.groupBy("product_type").agg(
        F.count(F.lit(1)).alias("items"),
        total(F.col("complete"), "with_dims"),
        total(1 - F.coalesce("complete", F.lit(0)), "missing_dims"),
        total(1 - F.coalesce("pictured", F.lit(0)), "missing_images"),
        total(F.col("failed"), "failed"),
        total(F.col("swapped"), "swapped"),
    )
