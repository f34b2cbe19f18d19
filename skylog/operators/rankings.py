"""Worst periods, worst hours, ranks and changes between periods."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skylog.functions.numeric import mean, peak, round2
from skylog.operators.rows import first_per_key


def worst_periods(obs: DataFrame, keys: Sequence[str] = ("city", "year", "month"), limit: int = 20) -> DataFrame:
    """The groups with the highest rounded average level; ties go by key.

    ``keys=("city", "month")`` pools the same month of all years.
    """
    return (
        obs.groupBy(*keys)
        .agg(mean("us_aqi", "avg_aqi"), mean("pm2_5", "avg_pm2_5"), peak("us_aqi", "max_aqi"))
        .orderBy(F.desc_nulls_first("avg_aqi"), *keys)
        .limit(limit)
    )


# The columns shown for a single hour.
HOUR_COLUMNS = (
    "city",
    "timestamp",
    "us_aqi",
    "pm2_5",
    "pm10",
    "temperature_2m",
    "relative_humidity_2m",
    "wind_speed_10m",
    "precipitation",
)


def worst_hours(obs: DataFrame, columns: Sequence[str] = HOUR_COLUMNS, level: str = "us_aqi", limit: int = 25) -> DataFrame:
    """The rows with the highest level, an unknown level first; ties go by city and time.

    Every task keeps its own ``limit`` rows; there is no global sort.
    """
    return obs.select(*columns).orderBy(F.desc_nulls_first(level), "city", "timestamp").limit(limit)


# Ranges that the distinct averages are dealt to, and how the averages become ranks. ``averages`` has a column that is not
# deterministic, so that it is not copied into each of its uses: they share one exchange, and the input is read once.
RANGES = 200
_RANKS = """
    WITH averages AS (SELECT *, rand() AS _once FROM {groups}),
    levels AS (SELECT _level, count(*) AS _groups FROM averages GROUP BY _level),
    cuts AS (SELECT approx_percentile(_level, array(%s)) AS _cuts FROM levels),
    ranged AS (
        SELECT _level, _groups, coalesce(size(filter(_cuts, c -> c > _level)), 0) AS _range
        FROM (SELECT *, (SELECT _cuts FROM cuts) AS _cuts FROM levels)),
    sizes AS (SELECT _range, sum(_groups) AS _groups FROM ranged GROUP BY _range),
    earlier AS (SELECT _range, sum(_groups) OVER (ORDER BY _range) - _groups AS _before FROM sizes),
    ranks AS (
        SELECT _level AS _ranked, _before + sum(_groups) OVER (PARTITION BY _range ORDER BY _level DESC NULLS FIRST) - _groups + 1 AS aqi_rank
        FROM ranged JOIN earlier USING (_range))
    SELECT aqi_rank, averages.* EXCEPT (_level, _once) FROM averages JOIN ranks ON _level <=> _ranked
""" % ", ".join(f"{i / RANGES}D" for i in range(1, RANGES))


def _exact_level(column: str) -> Column:
    """An average whose sum does not depend on its order, so that a task that runs again gives the same one.

    Values count on twelve decimals. A group with a value of 1e15 and more, or NaN, stands by the largest of those.
    """
    value = F.col(column).cast("double")
    small = F.abs(value) < 1e15
    whole = F.sum(F.when(small, value.cast("decimal(28,12)"))).cast("double")
    return F.coalesce(F.max(F.when(~small, value)), whole / F.nullif(F.count(column), F.lit(0)))


def rank_groups(obs: DataFrame, keys: Sequence[str] = ("city",)) -> DataFrame:
    """Rank of every group by its unrounded average level, worst first, equal ones sharing a rank.

    A rank over everything would send all groups to one task. Here equal
    averages are counted together and dealt to ranges between fixed cut points,
    approximate percentiles of the averages themselves; a rank is one more than
    the groups in earlier ranges and those ahead in the same range. The window
    over all ranges sees one row of each. One lazy plan; nothing is written.
    """
    groups = obs.groupBy(*keys).agg(
        _exact_level("us_aqi").alias("_level"), mean("us_aqi", "avg_aqi"), mean("pm2_5", "avg_pm2_5"), mean("pm10", "avg_pm10")
    )
    return obs.sparkSession.sql(_RANKS, groups=groups).orderBy("aqi_rank", *keys)


def period_change(obs: DataFrame, group: Sequence[str] = ("city",), period: Sequence[str] = ("year", "month"), name: str = "month") -> DataFrame:
    """Average level per period beside that of the previous period present, and the difference.

    The window runs over one row per group and period.
    """
    averages = obs.groupBy(*group, *period).agg(F.avg("us_aqi").alias("_level"))
    previous = F.lag("_level").over(Window.partitionBy(*group).orderBy(*period))
    return (
        averages.withColumn("_previous", previous)
        .select(
            *group,
            *period,
            round2(F.col("_level")).alias("avg_aqi"),
            round2(F.col("_previous")).alias(f"previous_{name}_aqi"),
            round2(F.col("_level") - F.col("_previous")).alias("aqi_change"),
        )
        .orderBy(*group, *period)
    )


def worst_period_per_group(obs: DataFrame, group: Sequence[str] = ("city",), period: Sequence[str] = ("date",)) -> DataFrame:
    """For every group the period with the highest average level; ties go to the earliest."""
    averages = obs.groupBy(*group, *period).agg(
        F.avg("us_aqi").alias("_level"), mean("pm2_5", "avg_pm2_5"), peak("us_aqi", "max_aqi")
    )
    worst = first_per_key(averages, group, [F.desc_nulls_first("_level"), *[F.asc(p) for p in period]])
    return worst.select(
        *group, *period, round2(F.col("_level")).alias("avg_aqi"), "avg_pm2_5", "max_aqi"
    ).orderBy(F.desc_nulls_first("avg_aqi"), *group)
