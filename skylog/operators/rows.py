"""Row-level steps: concatenate, clean, and keep one row per key."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skylog.functions.time import with_calendar
from skylog.schemas import KEY


def concat_sources(frames: Sequence[DataFrame]) -> DataFrame:
    """Stack frames by column name, keeping every copy."""
    return reduce(DataFrame.unionByName, frames)


def drop_exact_duplicates(df: DataFrame) -> DataFrame:
    """One of each set of equal rows. Copies collapse before the shuffle, so a hot one costs no task more."""
    return df.dropDuplicates()


def clean_observations(df: DataFrame, unique: bool = False, ordered: bool = True) -> DataFrame:
    """Drop rows without a timestamp and exact duplicates, add the calendar, order by key.

    ``unique`` says that a one-to-one merge has already ruled duplicates out;
    ``ordered=False`` leaves the order to the writer, which sorts per file.
    """
    kept = df.na.drop(subset=["timestamp"])
    if not unique:
        kept = drop_exact_duplicates(kept)
    kept = with_calendar(kept)
    return kept.orderBy(*KEY) if ordered else kept


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """The first row of every key in the given order.

    Spark keeps one row per key and task before it shuffles (window group
    limit), so a key with many copies sends few rows to its reducer. The order
    must decide between any two copies for the result to be repeatable.
    """
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_place", place).where("_place = 1").drop("_place")
