"""Operators on the long attribute table (oms_id, attribute_id, attribute_value)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from calipers.functions.text import style_tags

DIMENSIONS = ["width", "height", "depth"]


def attribute_choice(product_type: Column, config: Mapping[str, Mapping[str, str]]) -> Column:
    """array<struct<dimension_name, dimension_guid>> of a product type, else of `DEFAULT`."""
    entries = []
    for kind, dims in config.items():
        pairs = [
            F.struct(F.lit(name).alias("dimension_name"), F.lit(guid).alias("dimension_guid"))
            for name, guid in dims.items()
        ]
        entries += [F.lit(kind), F.array(*pairs)]
    by_type = F.create_map(*entries)
    return F.coalesce(F.try_element_at(by_type, product_type), F.try_element_at(by_type, F.lit("DEFAULT")))


def dimension_attributes(images: DataFrame, config: Mapping[str, Mapping[str, str]]) -> DataFrame:
    """One row per item, product type and dimension: which attribute holds the value.

    Items come with many pictures, so the pairs are made distinct (map side first)
    before they are multiplied by the dimensions.
    """
    return (
        images.select("oms_id", "product_type")
        .distinct()
        .select("oms_id", F.explode(attribute_choice(F.col("product_type"), config)).alias("dimension"))
        .select("oms_id", "dimension.dimension_guid", "dimension.dimension_name")
    )


def pivot_dimensions(wanted: DataFrame, feed: DataFrame, attribute_ids: Sequence[str] | None = None) -> DataFrame:
    """One row per item with width, height and depth text; null where the feed has none.

    Several values of one attribute: the least one counts. Taking it before the
    join leaves one row per join key on either side, however often a value repeats.
    Attributes that no item wants go first, so that they are neither sorted nor moved; the ids wanted are few.
    """
    if attribute_ids is not None:
        feed = feed.where(F.col("attribute_id").isin(list(attribute_ids)))
    else:
        used = wanted.select(F.col("dimension_guid").alias("attribute_id")).distinct()
        feed = feed.join(F.broadcast(used), on="attribute_id", how="left_semi")
    single = feed.groupBy("oms_id", "attribute_id").agg(F.min("attribute_value").alias("attribute_value"))
    return (
        wanted.withColumnRenamed("dimension_guid", "attribute_id")
        .distinct()
        .join(single.hint("merge"), on=["oms_id", "attribute_id"], how="left")  # rows of all items: never broadcast
        .groupBy("oms_id")
        .pivot("dimension_name", DIMENSIONS)
        .agg(F.min("attribute_value"))
        .select("oms_id", *DIMENSIONS)
    )


def attribute_product(feed: DataFrame, columns: Mapping[str, str]) -> DataFrame:
    """Items that have every attribute, one row per combination of their values.

    `columns` maps an output column to an attribute id. Every branch reads only its
    attribute, all joins use the item key, so each branch is exchanged once; a hot
    item is split by the skew join and never gathered into one list.
    """
    wide: DataFrame | None = None
    for name, attribute_id in columns.items():
        part = feed.where(F.col("attribute_id") == attribute_id).select(
            "oms_id", F.col("attribute_value").alias(name)
        )
        wide = part if wide is None else wide.join(part, on="oms_id")
    assert wide is not None
    return wide


def items_with_values(feed: DataFrame, items: DataFrame, values: Sequence[str]) -> DataFrame:
    """Distinct catalogue items that hold one of the literal values; blanks in a literal count."""
    return (
        feed.where(F.col("attribute_value").isin(list(values)))
        .select("oms_id")
        .distinct()
        .join(items.select("oms_id"), on="oms_id", how="left_semi")
    )


def values_by_name(feed: DataFrame, dictionary: DataFrame, display_name: str, column: str) -> DataFrame:
    """Values of the attributes whose display name equals `display_name`, whatever its case."""
    ids = dictionary.where(F.lower("displayname") == display_name.lower()).select("attribute_id")
    return feed.join(ids, on="attribute_id").select("oms_id", F.col("attribute_value").alias(column))


def search_attributes(feed: DataFrame, dictionary: DataFrame, patterns: Sequence[str]) -> DataFrame:
    """Attributes in use whose lowered display name is LIKE every pattern."""
    named = dictionary
    for pattern in patterns:
        named = named.where(F.lower("displayname").like(pattern))
    used = feed.select("attribute_id").distinct()
    return used.join(named, on="attribute_id").select("attribute_id", "displayname").distinct()


def _styles(feed: DataFrame, style_id: str) -> DataFrame:
    return feed.where(F.col("attribute_id") == style_id).select("oms_id", F.col("attribute_value").alias("style"))


def style_counts(feed: DataFrame, style_id: str) -> DataFrame:
    return (
        _styles(feed, style_id)
        .groupBy("style")
        .agg(F.count(F.lit(1)).alias("style_freq"))
        .orderBy(F.desc("style_freq"), "style")
    )


def tag_counts(feed: DataFrame, style_id: str) -> DataFrame:
    """Use of each single tag of the comma lists. Whole styles are counted first, then split."""
    per_style = _styles(feed, style_id).groupBy("style").agg(F.count(F.lit(1)).alias("n"))
    return (
        per_style.select(F.explode(style_tags(F.col("style"))).alias("tag"), "n")
        .groupBy("tag")
        .agg(F.sum("n").alias("tag_freq"))
    )


def in_top_styles(feed: DataFrame, style_id: str, n: int = 10) -> DataFrame:
    """Item/style rows whose style is among the `n` most frequent ones (ties by name)."""
    top = style_counts(feed, style_id).limit(n).select("style")
    return _styles(feed, style_id).join(F.broadcast(top), on="style", how="left_semi").select("oms_id", "style")


def images_with_dimensions(images: DataFrame, dims: DataFrame, image_type: str | None = None) -> DataFrame:
    """Pictures of items with known dimensions, of one type if asked for."""
    if image_type is not None:
        images = images.where(F.col("image_type") == image_type)
    return images.join(dims, on="oms_id")


def with_text_key(df: DataFrame, key: str, name: str = "oms_id") -> DataFrame:
    """Join key as text, null where the value has none."""
    return df.withColumn(name, F.col(key).try_cast("string"))


def image_lists(images: DataFrame) -> DataFrame:
    """All picture ids of an item, sorted. Repeats go before the lists are gathered."""
    return (
        images.select("oms_id", "image_guid")
        .distinct()
        .groupBy("oms_id")
        .agg(F.sort_array(F.collect_list("image_guid")).alias("all_image_guids"))
    )


def first_rows(df: DataFrame, order: Sequence[str], n: int) -> DataFrame:
    """The first `n` rows in a stated order, with their position (1-based)."""
    from pyspark.sql import Window

    # the window sees n rows only: limit keeps n per partition before anything moves
    return df.orderBy(*order).limit(n).withColumn("position", F.row_number().over(Window.orderBy(*order)))


def nth_row(df: DataFrame, order: Sequence[str], n: int) -> DataFrame:
    return first_rows(df, order, n).where(F.col("position") == n)
