"""Dated feeds: which day to read."""

from __future__ import annotations

import datetime as dt
import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from calipers.functions.text import parse_day


def newest_snapshot(paths: DataFrame, prefix: str, max_date: str | None = None, divider: str = "-") -> DataFrame:
    """One row with the latest date folder below `prefix`, null if there is none."""
    date = divider.join([r"\d{4}", r"\d{2}", r"\d{2}"])
    text = F.regexp_extract("path", rf"^{re.escape(prefix)}/({date})(/.*)?$", 1)
    days = paths.select(parse_day(text, divider).alias("day"))
    if max_date is not None:
        days = days.where(F.col("day") <= parse_day(F.lit(max_date), divider))
    return days.agg(F.max("day").alias("newest"))


def lookback_day(table: DataFrame, start: dt.date, max_retries: int = 30) -> DataFrame:
    """The newest day with data in the `max_retries` + 1 days up to `start`."""
    first = start - dt.timedelta(days=max_retries)
    return table.where(F.col("snapshot_date").between(F.lit(first), F.lit(start))).agg(
        F.max("snapshot_date").alias("snapshot_date")
    )


def load_lookback(table: DataFrame, start: dt.date, max_retries: int = 30) -> DataFrame:
    """Rows of that day; no rows when the whole look-back is empty.

    The day is a scalar subquery on the partition column, so only its folder is read.
    """
    return table.where(F.col("snapshot_date") == lookback_day(table, start, max_retries).scalar())
