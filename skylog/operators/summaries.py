"""Grouped summaries of observations.

Every function is one ``groupBy``: Spark aggregates per task before it
shuffles, so the shuffle carries groups, not rows, and a group that holds a
third of all rows costs no task more than another.

Fixed values: the output column names in this module are those of the reporting
interface.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from skylog.functions.bands import AQI_CATEGORIES, AQI_RANGES, Bands, hours_in_range
from skylog.functions.numeric import count_rows, mean, peak, percentage, total


# --- reporting views ---------------------------------------------------------


def group_summary(obs: DataFrame, keys: Sequence[str] = ("city",), threshold: float = 100.0) -> DataFrame:
    """Level and pollutants per group, and how often the level exceeds the threshold."""
    above = F.count_if(F.col("us_aqi") > F.lit(threshold))
    suffix = f"{threshold:g}".replace(".", "_")
    return obs.groupBy(*keys).agg(
        count_rows("hourly_observations"),
        mean("us_aqi", "avg_aqi"),
        peak("us_aqi", "max_aqi"),
        mean("pm2_5", "avg_pm2_5"),
        mean("pm10", "avg_pm10"),
        mean("ozone", "avg_ozone"),
        above.alias(f"hours_above_aqi_{suffix}"),
        percentage(above, F.count(F.lit(1))).alias(f"pct_hours_above_aqi_{suffix}"),
    )


def monthly_summary(obs: DataFrame, keys: Sequence[str] = ("city", "year", "month")) -> DataFrame:
    return obs.groupBy(*keys).agg(
        count_rows("hourly_observations"),
        mean("us_aqi", "avg_aqi"),
        peak("us_aqi", "max_aqi"),
        mean("pm2_5", "avg_pm2_5"),
        mean("pm10", "avg_pm10"),
        mean("ozone", "avg_ozone"),
    )


def daily_summary(obs: DataFrame, keys: Sequence[str] = ("city", "date")) -> DataFrame:
    return obs.groupBy(*keys).agg(
        count_rows("hourly_observations"),
        mean("us_aqi", "avg_aqi"),
        peak("us_aqi", "max_aqi"),
        mean("pm2_5", "avg_pm2_5"),
        mean("pm10", "avg_pm10"),
        mean("temperature_2m", "avg_temperature"),
        mean("relative_humidity_2m", "avg_humidity"),
        mean("wind_speed_10m", "avg_wind_speed"),
        total("precipitation", "total_precipitation"),
    )


def hourly_pattern(obs: DataFrame, keys: Sequence[str] = ("city", "hour")) -> DataFrame:
    return obs.groupBy(*keys).agg(
        count_rows("observations"),
        mean("us_aqi", "avg_aqi"),
        mean("pm2_5", "avg_pm2_5"),
        mean("pm10", "avg_pm10"),
        mean("temperature_2m", "avg_temperature"),
        mean("wind_speed_10m", "avg_wind_speed"),
    )


def category_distribution(
    obs: DataFrame, keys: Sequence[str] = ("city",), level: str = "us_aqi", categories: Bands = AQI_CATEGORIES
) -> DataFrame:
    """Hours of every category that occurs in a group, and their share of the group's hours.

    The share is a window over the counted categories: at most one row per
    category and group.
    """
    counted = (
        obs.select(
            *keys,
            categories.label(level).alias("aqi_category"),
            categories.order(level).alias("category_order"),
        )
        .groupBy(*keys, "aqi_category", "category_order")
        .agg(count_rows("hours"))
    )
    group_hours = F.sum("hours").over(Window.partitionBy(*keys))
    return counted.withColumn("pct_city_hours", percentage(F.col("hours"), group_hours))


# --- analysis questions ------------------------------------------------------


def overview(obs: DataFrame, keys: Sequence[str] = ("city",)) -> DataFrame:
    """Groups by their average level, worst first."""
    return _pollution(obs, keys).orderBy(F.desc_nulls_first("avg_aqi"), *keys)


def trend(obs: DataFrame, keys: Sequence[str] = ("city", "year", "month")) -> DataFrame:
    """The same measures per group and period, in order of the keys; ``("city", "month")`` pools the years."""
    return _pollution(obs, keys).orderBy(*[F.asc_nulls_last(k) for k in keys])


def _pollution(obs: DataFrame, keys: Sequence[str]) -> DataFrame:
    return obs.groupBy(*keys).agg(
        mean("us_aqi", "avg_aqi"),
        mean("pm2_5", "avg_pm2_5"),
        mean("pm10", "avg_pm10"),
        peak("us_aqi", "max_aqi"),
        count_rows("hourly_observations"),
    )


def hours_per_range(obs: DataFrame, keys: Sequence[str] = ("city",), level: str = "us_aqi", ranges=AQI_RANGES) -> DataFrame:
    """One column per closed range with the hours in it; a value between two ranges is in none."""
    counts = [hours_in_range(level, low, high).alias(name) for name, low, high in ranges]
    return obs.groupBy(*keys).agg(*counts).orderBy(*[F.asc_nulls_last(k) for k in keys])


def exceedance(obs: DataFrame, keys: Sequence[str] = ("city",), level: str = "us_aqi", threshold: float = 100.0) -> DataFrame:
    """Hours above a threshold and their share, most hours first."""
    above = F.count_if(F.col(level) > F.lit(threshold))
    suffix = f"{threshold:g}".replace(".", "_")
    return (
        obs.groupBy(*keys)
        .agg(
            count_rows("total_hours"),
            above.alias(f"hours_above_{suffix}"),
            percentage(above, F.count(F.lit(1))).alias(f"pct_hours_above_{suffix}"),
        )
        .orderBy(F.desc(f"hours_above_{suffix}"), *keys)
    )


def by_hour(obs: DataFrame) -> DataFrame:
    return (
        obs.groupBy("hour")
        .agg(mean("us_aqi", "avg_aqi"), mean("pm2_5", "avg_pm2_5"), mean("pm10", "avg_pm10"))
        .orderBy(F.asc_nulls_last("hour"))
    )


def by_group_and_hour(obs: DataFrame, keys: Sequence[str] = ("city",)) -> DataFrame:
    return (
        obs.groupBy(*keys, "hour")
        .agg(mean("us_aqi", "avg_aqi"), mean("pm2_5", "avg_pm2_5"))
        .orderBy(*[F.asc_nulls_last(k) for k in (*keys, "hour")])
    )


def by_weekday(obs: DataFrame) -> DataFrame:
    return (
        obs.groupBy("day_of_week")
        .agg(mean("us_aqi", "avg_aqi"), mean("pm2_5", "avg_pm2_5"), count_rows("hourly_observations"))
        .orderBy(F.desc_nulls_first("avg_aqi"), "day_of_week")
    )


def by_band(
    obs: DataFrame,
    measure: str,
    bands: Bands,
    name: str,
    pollutants: dict[str, str] | None = None,
) -> DataFrame:
    """Level and pollutants per band of a measure, lowest band first.

    The order is that of the lowest value found in the band, which is not part
    of the result.
    """
    pollutants = pollutants or {"pm2_5": "avg_pm2_5", "pm10": "avg_pm10"}
    return (
        obs.withColumn(name, bands.label(measure))
        .groupBy(name)
        .agg(
            count_rows("observations"),
            mean("us_aqi", "avg_aqi"),
            *[mean(column, alias) for column, alias in pollutants.items()],
            F.min(measure).alias("_lowest"),
        )
        .orderBy(F.asc_nulls_last("_lowest"), name)
        .drop("_lowest")
    )


def by_condition(obs: DataFrame, condition, name: str) -> DataFrame:
    """Level and pollutants per value of a computed label, worst first."""
    return (
        obs.withColumn(name, condition)
        .groupBy(name)
        .agg(
            count_rows("observations"),
            mean("us_aqi", "avg_aqi"),
            mean("pm2_5", "avg_pm2_5"),
            mean("pm10", "avg_pm10"),
        )
        .orderBy(F.desc_nulls_first("avg_aqi"), name)
    )
