"""Readers and writers of the feeds. Schemas are fixed, never inferred."""

from __future__ import annotations

import datetime as dt
import json
import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from calipers.functions.text import dimension_value


def _text_schema(*names: str) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


ITEM_ATTRIBUTES = _text_schema("oms_id", "attribute_id", "attribute_value", "x1", "x2", "x3", "x4")
MERGED_IMAGES = _text_schema("product_type", "oms_id", "image_guid", "image_type")
# Stored column order of the dimension table: it is written as width, height, depth.
DIMENSIONS = _text_schema("oms_id", "width", "height", "depth")
PRODUCT_ROWS = _text_schema("omsid", "image_url", "width", "depth", "height", "canopy", "style", "taxonomy")


class DatedPath:
    """Path template with `<NAME>` slots; `fill` returns a new template."""

    def __init__(self, template: str):
        self.template = template

    def fill(self, slot: str, value: str) -> DatedPath:
        return DatedPath(self.template.replace(f"<{slot}>", value))

    def __str__(self) -> str:
        return self.template


def read_item_attributes(spark: SparkSession, path: str) -> DataFrame:
    """Headerless `|` feed; the four unused columns are pruned from the scan."""
    return (
        spark.read.schema(ITEM_ATTRIBUTES).option("sep", "|").csv(path)
        .select("oms_id", "attribute_id", "attribute_value")
    )


def read_merged_images(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(MERGED_IMAGES).csv(path)


def read_dimensions(spark: SparkSession, path: str, places: int) -> DataFrame:
    """Dimension texts parsed to numbers with at most `places` decimals."""
    raw = spark.read.schema(DIMENSIONS).csv(path)
    return raw.select("oms_id", *[dimension_value(F.col(c), places).alias(c) for c in ("width", "height", "depth")])


def read_product_rows(spark: SparkSession, path: str) -> DataFrame:
    """CSV with a header row and quoted commas; dims stay text."""
    return spark.read.schema(PRODUCT_ROWS).option("header", True).option("escape", '"').csv(path)


def read_config(spark: SparkSession, path: str) -> dict:
    """A small JSON config from any file system Spark can reach."""
    return json.loads(spark.read.text(path, wholetext=True).first()[0])


def read_image_listing(spark: SparkSession, folder: str) -> DataFrame:
    """path and length of every file below `folder`; the contents are not read."""
    return (
        spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder).select("path", "length")
    )


def write_dimensions(dims: DataFrame, folder: str, day: dt.date, suffix: str = "dimensions") -> str:
    """One folder per day; a folder that exists is an error, as is writing a day twice."""
    target = f"{folder.rstrip('/')}/{day:%Y-%m-%d}/{suffix}"
    dims.select("oms_id", "width", "height", "depth").write.mode("errorifexists").csv(target)
    return target


def write_snapshot(df: DataFrame, folder: str, day: dt.date) -> None:
    """Write one day of a table partitioned by `snapshot_date`, laid out for attribute filters.

    The day's folder is replaced as a whole, so writing a day again does not double it.

    Files hold ranges of (attribute, item): an attribute filter skips most of them,
    and a very common attribute is spread over several writers.
    """
    (
        df.withColumn("snapshot_date", F.lit(day))
        .repartitionByRange("attribute_id", "oms_id")
        .sortWithinPartitions("attribute_id", "oms_id")
        .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .partitionBy("snapshot_date").parquet(folder)
    )


def snapshot_days(spark: SparkSession, folder: str) -> list[dt.date]:
    """The days of a table written by `write_snapshot`, oldest first, from the names of its folders; no file is opened."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    system = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not system.exists(path):
        return []
    names = [status.getPath().getName() for status in system.listStatus(path)]
    return sorted(dt.date.fromisoformat(n.split("=")[1]) for n in names if re.fullmatch(r"snapshot_date=\d{4}-\d\d-\d\d", n))


def read_lookback(spark: SparkSession, folder: str, start: dt.date, max_retries: int = 30) -> DataFrame | None:
    """The newest day with rows in the `max_retries` + 1 days up to `start`; None when the whole look-back is empty.

    The day comes from the folder names, so the files of other days are not opened. A day whose files hold
    no row is passed over.
    """
    first = start - dt.timedelta(days=max_retries)
    for day in reversed([d for d in snapshot_days(spark, folder) if first <= d <= start]):
        rows = spark.read.option("basePath", folder).parquet(f"{folder.rstrip('/')}/snapshot_date={day:%Y-%m-%d}")
        if not rows.isEmpty():
            return rows
    return None


def write_review(records: DataFrame, folder: str) -> None:
    records.write.mode("errorifexists").json(folder)


def write_by_product_type(df: DataFrame, folder: str) -> None:
    """One folder per product type."""
    df.write.mode("errorifexists").partitionBy("product_type").csv(folder, header=True)
