"""Rounded aggregates, percentages and NaN handling."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def round2(value: Column) -> Column:
    """Two decimals, half away from zero, decided on the decimal value.

    ``round(double)`` looks at the binary value, so that the noise of the order
    of a sum can turn 70.695 into 70.69 or 70.70. Twelve decimals drop it.
    Values of 1e15 and more have no two decimals as doubles and stay as they are.
    """
    number = value.cast("double")
    return F.when(F.abs(number) < 1e15, F.round(value.try_cast("decimal(28,12)"), 2).cast("double")).otherwise(number)


def percentage(part: Column, whole: Column) -> Column:
    return round2(F.lit(100.0) * part / F.nullif(whole, F.lit(0)))


def count_rows(name: str) -> Column:
    return F.count(F.lit(1)).alias(name)


def mean(column: str, name: str) -> Column:
    return round2(F.avg(column)).alias(name)


def peak(column: str, name: str) -> Column:
    return round2(F.max(column)).alias(name)


def total(column: str, name: str) -> Column:
    return round2(F.sum(column)).alias(name)


def without_nan(df: DataFrame) -> DataFrame:
    """NaN becomes null in every floating column, where it would otherwise compare as the largest value."""
    floats = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    return df.withColumns({c: F.nanvl(F.col(c), F.lit(None)) for c in floats}) if floats else df
