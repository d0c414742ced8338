"""Tables that describe what is written: file names, review records, missing pictures."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from calipers.functions.media import join_path, rendition_name
from calipers.operators.attributes import DIMENSIONS, image_lists


def renditions(pictures: DataFrame, sizes: Sequence[int], folder: Column) -> DataFrame:
    """One row per picture and size: file name and path. `pictures` has oms_id, filename."""
    return (
        pictures.select("*", F.explode(F.array(*[F.lit(s) for s in sizes])).alias("size"))
        .withColumn("sized_name", rendition_name(F.col("filename"), F.col("size")))
        .withColumn("path", join_path(folder, F.col("sized_name")))
        .select("oms_id", "size", "sized_name", "path")
    )


def debug_names(pictures: DataFrame, count: Column) -> DataFrame:
    """File names `item_0.jpg` .. of the `count` debug pictures of an item; none for a count of 0."""
    steps = F.when(count > 0, F.sequence(F.lit(0), (count - 1).cast("int")))
    return pictures.select("oms_id", F.explode(steps).alias("step")).withColumn(
        "filename", F.concat("oms_id", F.lit("_"), F.col("step").cast("string"), F.lit(".jpg"))
    )


def review_records(dims: DataFrame, chosen: DataFrame, images: DataFrame, folder: str) -> DataFrame:
    """Review record per item: location, dims as text, the chosen picture and all pictures."""
    return (
        chosen.join(dims, on="oms_id")
        .join(image_lists(images), on="oms_id")
        .select(
            "oms_id",
            join_path(F.lit(folder), F.col("product_type"), F.concat("oms_id", F.lit(".jpg"))).alias(
                "dimension_image_location"
            ),
            F.struct(*DIMENSIONS).alias("dimensions"),
            F.col("image_guid").alias("selected_img_guid"),
            F.col("image_type").alias("selected_img_type"),
            "all_image_guids",
        )
    )


def as_json(records: DataFrame) -> DataFrame:
    """One JSON text per record; absent dims stay as null fields."""
    body = F.to_json(F.struct(*records.columns), {"ignoreNullFields": "false"})
    return records.select("oms_id", body.alias("record"))


def missing_images(images: DataFrame, listing: DataFrame) -> DataFrame:
    """Catalogue pictures without a readable (non-empty) file in the listing (path, length)."""
    guid = F.regexp_extract("path", r"([^/]+?)(\.[^./]*)?$", 1)
    present = listing.where(F.col("length") > 0).select(guid.alias("image_guid")).distinct()
    return images.select("image_guid").distinct().join(present, on="image_guid", how="left_anti")


def choose_views(labels: DataFrame, candidates: DataFrame) -> DataFrame:
    """Best-scored picture of the view each item was labelled with; items labelled `neither` drop out.

    `labels`: oms_id, product_type, image_view; `candidates`: oms_id, image_guid, image_view, score.
    Equal scores: the least guid.
    """
    best = candidates.groupBy("oms_id", "image_view").agg(
        F.min(F.struct((-F.col("score")).alias("loss"), F.col("image_guid").alias("guid"))).alias("best")
    )
    return (
        labels.where(F.col("image_view").isin("SIDE", "FRONT"))
        .join(best, on=["oms_id", "image_view"])
        .select("product_type", "oms_id", F.col("best.guid").alias("image_guid"), "image_view")
    )


def chosen_images(images: DataFrame) -> DataFrame:
    """One picture per item: a front one if there is any, then the least guid."""
    best = images.groupBy("oms_id", "product_type").agg(F.min(F.struct("image_type", "image_guid")).alias("best"))
    return best.select("product_type", "oms_id", "best.image_guid", "best.image_type")
