"""Registered queries: (spark, sf_dir) -> DataFrame, each over whole tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from calipers.functions import media, text
from calipers.operators import attributes as A
from calipers.operators import corners as C
from calipers.operators import exports as X
from calipers.operators import hull as H
from calipers.operators import layout as L
from calipers.operators import rings as R
from calipers.operators import segments as S
from calipers.operators import silhouette as I
from calipers.operators import snapshots as N
from calipers.plans import jobs
from calipers.runtime import only, scratch
from calipers.sources import adapters as V
from calipers.sources import feeds, sql

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

CONFIG = L.DrawingConfig(swap_types=("PROMO", "LARGE", "SMALL"))
EAV_COLUMNS = {"width": "a-width", "depth": "a-depth", "height": "a-height", "style": "a-style"}
COLLECTION_COLUMNS = {"width": "a-width", "depth": "a-depth", "height": "a-height", "length": "a-length"}
COLLECTION_VALUES = [" PROMO", "LARGE", "SMALL "]  # blanks belong to the literals
LOOKBACK_START = dt.date(2001, 8, 20)
OUTLINE_SIZE = 400
GAP, REACH = 5.0, 6  # canopy walk on the small test pictures
SPECK_SHARE = 0.01  # the usual share is less than a pixel there


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def rounded(df: DataFrame) -> DataFrame:
    """Doubles to six decimals (and no negative zero), for comparison between engines."""
    return df.select(*[
        (F.round(f.name, 6) + F.lit(0.0)).alias(f.name) if isinstance(f.dataType, T.DoubleType) else F.col(f.name)
        for f in df.schema.fields
    ])


def _lines(df: DataFrame, *keys: str) -> DataFrame:
    """Layout rows as one row per dimension line."""
    lines = F.array(*[
        F.struct(F.lit(n).alias("dim_name"), F.col(n).alias("at")) for n in L.ORDER
    ])
    flat = df.select(*keys, "center_x", "center_y", F.inline(lines))
    return rounded(flat.select(*keys, "dim_name", "at.x1", "at.y1", "at.x2", "at.y2", "center_x", "center_y"))


def _flag(c: Column) -> Column:
    return F.when(c, "yes").otherwise("no")


# --- items, attributes, text ---------------------------------------------------------------


@query
def dim_lookup(spark, d):
    found = jobs.dimension_lookup(V.merged_images(spark, d), V.item_attributes(spark, d), V.DIMENSION_CONFIG)
    return rounded(found)


@query
def dimension_job(spark, d):
    """The feed is stored as a day within the look-back and one before it; what the job writes is read back."""
    folder, feed = scratch(spark, "feed"), V.item_attributes(spark, d)
    start, used = dt.date(2021, 5, 10), dt.date(2021, 5, 7)
    feeds.write_snapshot(feed, folder, used)
    feeds.write_snapshot(feed.withColumn("attribute_value", F.lit("1 in")), folder, dt.date(2021, 4, 1))
    day, target = jobs.dimension_job(V.merged_images(spark, d), folder, V.DIMENSION_CONFIG, start, scratch(spark, "dims"))
    return feeds.read_dimensions(spark, target, 2).withColumn("day", F.lit(f"{day:%Y-%m-%d}"))


@query
def dim_guids(spark, d):
    return A.dimension_attributes(V.merged_images(spark, d), V.DIMENSION_CONFIG)


@query
def pivot_dims(spark, d):
    wanted = A.dimension_attributes(V.items(spark, d), V.DIMENSION_CONFIG)
    return A.pivot_dimensions(wanted, V.item_attributes(spark, d))


@query
def eav_product(spark, d):
    return A.attribute_product(V.item_attributes(spark, d), EAV_COLUMNS)


@query
def parse_dim(spark, d):
    value = F.col("attribute_value")
    return V.item_attributes(spark, d).select(
        "oms_id", "attribute_id", "attribute_value",
        text.dimension_value(value, 0).alias("whole"),
        text.dimension_value(value, 1).alias("tenths"),
        text.dimension_value(value, 2).alias("hundredths"),
    )


@query
def first_token_num(spark, d):
    number = text.leading_number(F.col("attribute_value"))
    return rounded(V.item_attributes(spark, d).select(
        "oms_id", "attribute_id", "attribute_value", number.alias("number"),
        F.when(number.isNull(), "bad").otherwise("ok").alias("status"),
    ))


@query
def label_text(spark, d):
    value = F.col("attribute_value")
    return V.item_attributes(spark, d).select(
        "oms_id", "attribute_id", "attribute_value",
        text.inches_label(text.dimension_value(value, 0), 0).alias("label_0"),
        text.inches_label(text.dimension_value(value, 2), 2).alias("label_2"),
    )


@query
def feet_inches(spark, d):
    return V.table(spark, d, "lineitem").select(
        "l_orderkey", "l_extendedprice", text.feet_inches_label(F.col("l_extendedprice")).alias("label")
    )


@query
def rug_size(spark, d):
    size = text.rug_size(F.col("product_name"))
    return rounded(
        V.rugs(spark, d).select("omsid", "product_name", size.alias("s"))
        .select("omsid", "product_name", F.col("s.width").alias("width"), F.col("s.height").alias("height"),
                F.when(F.col("s").isNull(), "bad").otherwise("ok").alias("status"))
    )


def _rugs(spark, d):
    return jobs.rug_dimensions(
        V.rugs(spark, d), V.item_attributes(spark, d), ["a-thick1", "a-thick2"], "a-image"
    )


@query
def rug_dims(spark, d):
    return rounded(_rugs(spark, d))


@query
def rug_labels(spark, d):
    dims = F.array(*[
        F.struct(F.lit(n).alias("dim_name"), F.col(f"{n}_in").alias("number")) for n in L.ORDER
    ])
    items = _rugs(spark, d).select("oms_id", *[f"{n}_in" for n in L.ORDER]).distinct()
    return rounded(items.select("oms_id", F.inline(dims)).withColumn(
        "label", text.rug_label(F.col("dim_name"), F.col("number"), CONFIG.num_dim_decimal_pts)
    ))


@query
def image_guid(spark, d):
    return V.image_urls(spark, d).select(
        "oms_id", "image_url", media.guid_of_url(F.col("image_url")).alias("image_guid"),
        media.guid_of_url(F.col("image_url"), 9).alias("past_end"),
    )


@query
def image_name(spark, d):
    bare = V.merged_images(spark, d).select("oms_id", F.col("image_guid").alias("image"))
    full = V.image_urls(spark, d).select(F.col("oms_id").cast("string").alias("oms_id"), F.col("image_url").alias("image"))
    parts = media.image_parts(F.col("image"), "https://images.example.com/assets/image")
    return bare.unionByName(full).select("oms_id", "image", parts.alias("p")).select("oms_id", "image", "p.*")


@query
def output_path(spark, d):
    styled = V.item_attributes(spark, d).where(F.col("attribute_id") == "a-style").select(
        "oms_id", F.col("attribute_value").alias("style")
    )
    rows = styled.join(V.items(spark, d), on="oms_id")
    title = media.output_title(F.col("oms_id"), F.col("style"))
    return rows.select(
        "oms_id", title.alias("title"),
        media.join_path(F.lit("out"), text.format_day(F.lit(LOOKBACK_START)), F.lit("output_images"),
                        F.col("product_type"), F.concat(title, F.lit(".jpg"))).alias("path"),
    )


@query
def bucket_blob(spark, d):
    path = F.concat(F.when(F.col("path").like("%staging%"), "").otherwise("gs://feeds/"), "path")
    return V.feed_paths(spark, d).select(path.alias("path")).select(
        "path", media.bucket_and_blob(F.col("path")).alias("p")
    ).select("path", "p.*")


@query
def date_format(spark, d):
    written = text.format_day(F.to_date("o_orderdate"), "/")
    back = text.parse_day(written, "/")
    return V.table(spark, d, "orders").select(
        "o_orderkey", written.alias("written"), text.format_day(back).alias("dashed"),
        text.format_day(text.parse_day(F.col("o_orderpriority"))).alias("not_a_day"),
    )


@query
def newest_snapshot(spark, d):
    paths = V.feed_paths(spark, d)
    every = N.newest_snapshot(paths, "feed/items").withColumn("bound", F.lit("none"))
    some = N.newest_snapshot(paths, "feed/items", "1999-06-15").withColumn("bound", F.lit("1999-06-15"))
    return every.unionByName(some).select("bound", text.format_day(F.col("newest")).alias("newest"))


@query
def lookback_snapshot(spark, d):
    rows = N.load_lookback(V.attribute_snapshots(spark, d), LOOKBACK_START)
    return rows.select(text.format_day(F.col("snapshot_date")).alias("snapshot_date"), "oms_id", "attribute_value")


@query
def images_with_dims(spark, d):
    found = jobs.dimension_lookup(V.merged_images(spark, d), V.item_attributes(spark, d), V.DIMENSION_CONFIG)
    dims = found.select("oms_id", *[F.col(f"{n}_in").alias(n) for n in A.DIMENSIONS])
    return rounded(A.images_with_dimensions(V.merged_images(spark, d), dims, "FRONT"))


@query
def lighting_items(spark, d):
    return A.items_with_values(V.item_attributes(spark, d), V.items(spark, d), COLLECTION_VALUES)


@query
def collection_dims(spark, d):
    return jobs.collection_dimensions(
        V.item_attributes(spark, d), V.items(spark, d), V.attributes(spark, d), COLLECTION_VALUES, COLLECTION_COLUMNS
    )


@query
def front_items(spark, d):
    columns = {"width": "a-width", "depth": "a-depth", "height": "a-height", "canopy": "a-canopy",
               "image_guid": "a-image"}
    found = jobs.front_items(
        V.image_urls(spark, d), V.items(spark, d), V.item_attributes(spark, d), columns, "a-style",
        like=["%ring%"], unlike=["%new%", "%old%"],
    )
    return rounded(found.withColumn("canopy_in", text.leading_number(F.col("canopy"))))


@query
def attr_search(spark, d):
    return A.search_attributes(V.item_attributes(spark, d), V.attributes(spark, d), ["%canopy%", "%in.%"])


@query
def style_counts(spark, d):
    return A.style_counts(V.item_attributes(spark, d), "a-style")


@query
def style_tags(spark, d):
    return A.tag_counts(V.item_attributes(spark, d), "a-style")


@query
def top_styles(spark, d):
    return A.in_top_styles(V.item_attributes(spark, d), "a-style")


@query
def image_arrays(spark, d):
    lists = A.image_lists(V.merged_images(spark, d))
    return lists.select("oms_id", F.size("all_image_guids").alias("n"),
                        F.array_join("all_image_guids", "|").alias("all_image_guids"))


@query
def review_json(spark, d):
    images = V.merged_images(spark, d)
    dims = A.pivot_dimensions(A.dimension_attributes(images, V.DIMENSION_CONFIG), V.item_attributes(spark, d))
    return X.as_json(X.review_records(dims, X.chosen_images(images), images, "out/output_images"))


@query
def missing_images(spark, d):
    return X.missing_images(V.merged_images(spark, d), V.stored_images(spark, d))


@query
def renditions(spark, d):
    named = V.items(spark, d).select("oms_id", F.concat("oms_id", F.lit(".jpg")).alias("filename"))
    return X.renditions(named, [100, 400, 1000], F.lit("out/output_images"))


@query
def debug_manifest(spark, d):
    rows = V.table(spark, d, "part").select(F.col("p_partkey").cast("string").alias("oms_id"), "p_size")
    return X.debug_names(rows, F.col("p_size") - 5)


@query
def view_choice(spark, d):
    return X.choose_views(V.view_labels(spark, d), V.view_candidates(spark, d))


@query
def nth_row(spark, d):
    urls = V.image_urls(spark, d)
    first = A.first_rows(urls, ["oms_id", "image_url"], 100)
    return first.select("position", "oms_id", "image_url").withColumn(
        "chosen", _flag(F.col("position") == 6)
    )


# --- pixels -------------------------------------------------------------------------------


@query
def grey_mask(spark, d):
    return V.pixels(spark, d).select(
        "image_id", "x", "y", I.luminance().alias("luminance"), I.grey().cast("int").alias("grey"),
        I.grey(I.GREY_SWAPPED).cast("int").alias("grey_swapped"),
    )


@query
def smoothed_mask(spark, d):
    level = I.smoothed(V.pixels(spark, d))
    return level.select("image_id", "x", "y", F.col("level").cast("int").alias("level"),
                        F.when(F.col("level") <= I.CONTOUR_THRESHOLD, 1).otherwise(0).alias("foreground"))


def _labelled(spark, d):
    px = V.pixels(spark, d)
    return px, I.labelled_runs(I.luminance_mask(px))


@query
def components(spark, d):
    px, runs = _labelled(spark, d)
    kept = I.drop_specks(I.component_areas(runs), I.image_sizes(px), SPECK_SHARE)
    return kept.select("image_id", "label", "area", "top")


@query
def large_components(spark, d):
    _, runs = _labelled(spark, d)
    return I.keep_large(I.component_areas(runs)).select("image_id", "label", "area", "largest")


@query
def adaptive_mask(spark, d):
    parts = I.adaptive_runs(V.pixels(spark, d), speck_share=SPECK_SHARE).groupBy("image_id", "cutoff", "label").agg(F.max("area").alias("area"))
    return parts.groupBy("image_id", "cutoff").agg(
        F.count(F.lit(1)).alias("parts"), F.sum("area").cast("long").alias("area")
    )


@query
def bounding_boxes(spark, d):
    return I.silhouette_boxes(I.adaptive_runs(V.pixels(spark, d), speck_share=SPECK_SHARE))


@query
def cropped_check(spark, d):
    runs = I.labelled_runs(I.contour_mask(V.pixels(spark, d)))
    return I.cropped_check(I.largest_component(I.component_areas(runs)))


def _shapes(spark, d):
    return only(lambda: I.largest_shape_runs(I.contour_mask(V.pixels(spark, d))))


@query
def extreme_points(spark, d):
    return I.extreme_points(_shapes(spark, d))


@query
def hull(spark, d):
    return H.hull_points(H.convex_hulls(_shapes(spark, d)))


@query
def canopy_ends(spark, d):
    runs = _shapes(spark, d)
    ends = H.canopy_ends(H.convex_hulls(runs), I.extreme_points(runs), GAP, REACH)
    line = H.canopy_line(ends, *ends.columns[1:])
    return line.select(*ends.columns, F.col("y1").alias("line_y1"), F.col("y2").alias("line_y2"))


@query
def canopy_label(spark, d):
    runs = _shapes(spark, d)
    images = V.table(spark, d, "part").select(
        F.col("p_partkey").alias("image_id"), F.lit(V.IMAGE_WIDTH).alias("img_w"), F.lit(V.IMAGE_HEIGHT).alias("img_h"),
        ((F.col("p_size") % 6) + 0.25).cast("double").alias("canopy_in"),
    )
    made = jobs.canopy_labels(
        H.convex_hulls(runs), I.extreme_points(runs), images, CONFIG, away=(12.0, 30.0), gap=GAP, reach=REACH
    )
    return rounded(made.select("image_id", "label", "line_width", "canvas_w", "canvas_h", "at.x1", "at.y1", "at.x2",
                               "at.y2", "at_left", "at_top"))


# --- layout -------------------------------------------------------------------------------


@query
def border_boxes(spark, d):
    return I.bordered_images(V.boxes(spark, d), CONFIG.border_ratio).select(
        "oms_id", "img_w", "img_h", "border", "bordered_w", "bordered_h",
        (F.col("min_x") + F.col("border")).alias("min_x"), (F.col("max_y") + F.col("border")).alias("max_y"),
    )


@query
def line_specs(spark, d):
    return jobs.boxes_with_border(V.boxes(spark, d), CONFIG).select(
        "oms_id", "line_margin", "line_width", "font_size"
    )


def _front(spark, d, rug=False):
    return L.front_layout(jobs.boxes_with_border(V.boxes(spark, d), CONFIG), CONFIG, rug)


@query
def front_layout(spark, d):
    return _lines(_front(spark, d), "oms_id")


@query
def rug_layout(spark, d):
    return _lines(_front(spark, d, rug=True), "oms_id")


def _side(spark, d):
    segments, images = V.outline_segments(spark, d), _outline_images(spark, d)
    return jobs.side_layouts(segments, images)


def _outline_images(spark, d):
    return V.table(spark, d, "part").select(
        F.col("p_partkey").alias("image_id"), F.lit(OUTLINE_SIZE).alias("img_w"), F.lit(OUTLINE_SIZE).alias("img_h")
    )


@query
def side_layout(spark, d):
    return _lines(_side(spark, d), "image_id", "status")


@query
def really_front(spark, d):
    return _side(spark, d).select("image_id", "status", _flag(L.is_really_front(CONFIG)).alias("really_front"))


def _dims(spark, d):
    found = jobs.dimension_lookup(V.items(spark, d), V.item_attributes(spark, d), V.DIMENSION_CONFIG)
    return found.select("oms_id", *[f"{n}_in" for n in A.DIMENSIONS])


@query
def swap_check(spark, d):
    rows = _front(spark, d).join(_dims(spark, d), on="oms_id")
    swap = L.should_swap(CONFIG, F.col("width_in"), F.col("height_in"), F.col("depth_in"))
    return rows.select("oms_id", "product_type", _flag(swap).alias("fits_better"),
                       _flag(swap & F.col("product_type").isin(list(CONFIG.swap_types))).alias("swapped"))


def _modes(spark, d):
    side = _side(spark, d).withColumn("oms_id", F.col("image_id").cast("string")).drop("image_id")
    views = V.view_labels(spark, d).where(F.col("image_view") != "neither").select(
        "oms_id", F.col("image_view").alias("image_type")
    )
    return jobs.layout_by_mode(_front(spark, d).join(views.hint("merge"), on="oms_id"), side, CONFIG)


@query
def layout_mode(spark, d):
    return _lines(_modes(spark, d), "oms_id", "image_type", "mode", "status")


@query
def label_place(spark, d):
    rows = _front(spark, d).withColumns({
        f"{n}_label": L.placed_label(n, F.col("center_x"), F.col("center_y"), F.col("font_size") * 2.5,
                                     F.col("font_size") * 1.15, F.col("line_margin"), CONFIG)
        for n in L.ORDER
    })
    flat = rows.select("oms_id", F.inline(F.array(*[
        F.struct(F.lit(n).alias("dim_name"), F.col(f"{n}_label").alias("at")) for n in L.ORDER
    ])))
    return rounded(flat.select("oms_id", "dim_name", "at.*"))


def _annotated(spark, d, rug=False):
    dims = L.label_texts(_dims(spark, d), CONFIG, rug)
    rows = _front(spark, d, rug).join(dims, on="oms_id")
    return L.annotate(rows.withColumns({"canvas_w": F.col("bordered_w"), "canvas_h": F.col("bordered_h")}), CONFIG)


@query
def extra_border(spark, d):
    return _annotated(spark, d).select(
        "oms_id", "canvas_w", "canvas_h", *[f"{n}_label_{k}" for n in L.ORDER for k in ("left", "top")]
    )


@query
def end_caps(spark, d):
    rows = _annotated(spark, d, rug=True)
    flat = rows.select("oms_id", F.inline(F.array(*[
        F.struct(F.lit(n).alias("dim_name"), L.end_caps(L.shifted(f"{n}_label"), F.lit(n), CONFIG).alias("caps"))
        for n in L.ORDER
    ])))
    return rounded(flat.select("oms_id", "dim_name", F.posexplode("caps").alias("cap", "at")).select(
        "oms_id", "dim_name", "cap", "at.*"))


@query
def depth_text(spark, d):
    rows = _annotated(spark, d)
    point = L.depth_text_point(L.shifted("depth_label"), CONFIG)
    return rounded(rows.select("oms_id", "depth_text", point.alias("p")).select("oms_id", "depth_text", "p.*"))


@query
def text_anchor(spark, d):
    boxes = V.boxes(spark, d)
    name = lambda c, *names: F.element_at(F.array(*[F.lit(n) for n in names]), (F.col(c) % len(names) + 1).cast("int"))
    rows = boxes.select("oms_id", "min_x", "min_y", name("img_w", "center", "right", "left", "middle").alias("x_align"),
                        name("img_h", "center", "bottom", "top").alias("y_align"))
    corner = L.text_corner(F.col("min_x"), F.col("min_y"), F.lit(90.0), F.lit(31.0), F.col("x_align"), F.col("y_align"))
    return rounded(rows.withColumn("p", corner).select(
        "oms_id", "x_align", "y_align", F.col("p.x").alias("x"), F.col("p.y").alias("y"),
        F.when(F.col("p").isNull(), "bad").otherwise("ok").alias("status")))


@query
def text_size(spark, d):
    labels = L.label_texts(_dims(spark, d), CONFIG, rug=True).join(
        jobs.boxes_with_border(V.boxes(spark, d), CONFIG).select("oms_id", "font_size"), on="oms_id")
    flat = labels.select("oms_id", "font_size", F.inline(F.array(*[
        F.struct(F.lit(n).alias("dim_name"), F.col(f"{n}_text").alias("label")) for n in L.ORDER
    ])))
    return rounded(flat.select("oms_id", "dim_name", "label",
                               L.text_width(F.col("label"), F.col("font_size")).alias("text_w"),
                               L.text_height(F.col("label"), F.col("font_size")).cast("double").alias("text_h")))


def _plan(spark, d):
    return jobs.annotation_plan(_modes(spark, d), _dims(spark, d), CONFIG)


@query
def annotation_plan(spark, d):
    plan = _plan(spark, d).withColumn("swapped", _flag(F.col("swapped")))
    return rounded(plan.select(*[c for c in plan.columns if c != "at"], "at.*"))


@query
def measured_boxes(spark, d):
    boxes = jobs.measured_boxes(V.picture_pixels(spark, d), V.pictures(spark, d), SPECK_SHARE)
    return boxes.select("image_id", "img_w", "img_h", *[f"{m}_{a}{s}" for s in ("", "_bb") for a in "xy" for m in ("min", "max")])


@query
def measured_plan(spark, d):
    """The annotation plan of pictures of several sizes, measured on their pixels."""
    views = V.view_labels(spark, d).where(F.col("image_view") != "neither").select(
        "oms_id", F.col("image_view").alias("image_type")
    )
    plan = jobs.measured_plan(
        V.picture_pixels(spark, d), V.pictures(spark, d), V.outline_segments(spark, d), _outline_images(spark, d), views,
        _dims(spark, d), CONFIG, SPECK_SHARE,
    ).withColumn("swapped", _flag(F.col("swapped")))
    return rounded(plan.select(*[c for c in plan.columns if c != "at"], "at.*"))


@query
def rug_plan(spark, d):
    """One row per line and end cap."""
    plan = jobs.rug_plan(V.boxes(spark, d), _rugs(spark, d), CONFIG)
    flat = plan.select("oms_id", "canvas_w", "canvas_h", "status", "dim_name", "label", "at.*", "text_x", "text_y",
                       F.posexplode("caps").alias("cap", "end"))
    ends = {f"cap_{k}": F.col(f"end.{k}") for k in ("x1", "y1", "x2", "y2")}
    return rounded(flat.withColumns(ends).drop("end"))


@query
def type_report(spark, d):
    return jobs.run_report(
        V.items(spark, d), _dims(spark, d).toDF("oms_id", *A.DIMENSIONS), V.merged_images(spark, d),
        V.stored_images(spark, d), _plan(spark, d),
    )


# --- SQL text over views and functions -----------------------------------------------------


@query
def sql_measures(spark, d):
    sql.prepare(spark, d)
    return spark.sql("""
        select oms_id, attribute_id, attribute_value, dimension_value(attribute_value) as hundredths,
            leading_number(attribute_value) as first_number,
            feet_inches(dimension_value(attribute_value)) as feet
        from item_attributes""")


@query
def sql_rugs(spark, d):
    sql.prepare(spark, d)
    return rounded(spark.sql("""
        select omsid, product_name, rug_width(product_name) as width, rug_height(product_name) as height,
            inches(rug_width(product_name)) as label from rugs"""))


@query
def sql_collection(spark, d):
    sql.prepare(spark, d)
    values = ", ".join(f"'{v}'" for v in COLLECTION_VALUES)
    measured = " ".join(
        f"join (select oms_id, attribute_value as {n} from wanted where attribute_id = '{a}') using (oms_id)"
        for n, a in COLLECTION_COLUMNS.items()
    )
    return spark.sql(f"""
        with wanted as (
            select v.* from item_attributes v left semi join (
                select oms_id from item_attributes left semi join items using (oms_id)
                where attribute_value in ({values})) using (oms_id)
        ), pictures as (
            select oms_id, attribute_value as image_guid from wanted join attributes using (attribute_id)
            where lower(displayname) = 'product image'
        )
        select oms_id, image_guid, {", ".join(COLLECTION_COLUMNS)} from pictures {measured}""")


@query
def sql_attr_search(spark, d):
    sql.prepare(spark, d)
    return spark.sql("""
        select distinct attribute_id, displayname from item_attributes join attributes using (attribute_id)
        where lower(displayname) like '%canopy%' and lower(displayname) like '%in.%'""")


# --- segments -----------------------------------------------------------------------------


def _edges(spark, d):
    return only(lambda: S.edges_of(V.segments(spark, d)))


@query
def segment_angles(spark, d):
    return rounded(S.with_angle(V.segments(spark, d)).select("image_id", "seg_id", "theta"))


@query
def similar_segments(spark, d):
    return S.similar_segments(V.segments(spark, d))


@query
def segment_groups(spark, d):
    return S.segment_groups(V.segments(spark, d))


@query
def edge_endpoints(spark, d):
    return rounded(_edges(spark, d).drop("seg1", "seg2"))


@query
def endpoint_pairs(spark, d):
    return rounded(C.endpoint_pairs(_edges(spark, d), 40.0))


@query
def ring_order(spark, d):
    return R.ring_order(_edges(spark, d))


@query
def ring_filter(spark, d):
    edges = _edges(spark, d)
    return R.ring_filter(edges, R.ring_order(edges)).select("image_id", "pos", "edge_id", "entry")


@query
def corner_match(spark, d):
    return rounded(C.match_corners(_edges(spark, d)))


@query
def corner_points(spark, d):
    edges = _edges(spark, d)
    sizes = edges.select("image_id").distinct().withColumns({"img_w": F.lit(500), "img_h": F.lit(500)})
    return rounded(C.corner_points(edges, C.match_corners(edges), sizes))
