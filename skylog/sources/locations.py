"""The location dimension."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from skylog.functions.text import slug
from skylog.schemas import LOCATION, LOCATIONS
from skylog.session import small_frame


def locations(spark: SparkSession, rows=LOCATIONS) -> DataFrame:
    """Configured cities with their coordinates and file-name slug."""
    frame = small_frame(spark, list(rows), LOCATION)
    return frame.withColumn("slug", slug(frame.city))


def with_location(df: DataFrame, dimension: DataFrame, on: str | list[str], how: str = "inner") -> DataFrame:
    """Look up a dimension row for every row of ``df``.

    No broadcast hint: the optimizer broadcasts the dimension when its size is
    under ``spark.sql.autoBroadcastJoinThreshold``, adaptive execution when it
    turns out so at run time, and a larger one is joined by shuffling.
    """
    return df.join(dimension, on, how)
