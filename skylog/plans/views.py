"""The reporting layer: named views over the observation fact, and the analysis questions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

from skylog.functions.bands import TEMPERATURE_BANDS, WIND_BANDS, rain_label
from skylog.operators import rankings, summaries

# View names and the question names below are the reporting interface.
VIEWS: dict[str, Callable[[DataFrame], DataFrame]] = {
    "vw_city_air_quality_summary": summaries.group_summary,
    "vw_monthly_air_quality": summaries.monthly_summary,
    "vw_daily_air_quality": summaries.daily_summary,
    "vw_hourly_patterns": summaries.hourly_pattern,
    "vw_aqi_categories": summaries.category_distribution,
}

QUESTIONS: dict[str, Callable[[DataFrame], DataFrame]] = {
    "city_overview": summaries.overview,
    "monthly_trend": summaries.trend,
    "worst_months": rankings.worst_periods,
    "worst_hours": rankings.worst_hours,
    "category_hours": summaries.hours_per_range,
    "threshold_exceedance": summaries.exceedance,
    "city_rank": rankings.rank_groups,
    "hour_of_day": summaries.by_hour,
    "hour_by_city": summaries.by_group_and_hour,
    "weekday_pattern": summaries.by_weekday,
    "wind_bands": lambda obs: summaries.by_band(obs, "wind_speed_10m", WIND_BANDS, "wind_speed_group"),
    "dry_wet": lambda obs: summaries.by_condition(obs, rain_label("precipitation"), "weather_condition"),
    "temperature_bands": lambda obs: summaries.by_band(
        obs,
        "temperature_2m",
        TEMPERATURE_BANDS,
        "temperature_range",
        {"pm2_5": "avg_pm2_5", "ozone": "avg_ozone"},
    ),
    "month_over_month": rankings.period_change,
    "worst_day": rankings.worst_period_per_group,
}


def build_views(obs: DataFrame) -> dict[str, DataFrame]:
    """Every reporting view as a lazy frame."""
    return {name: view(obs) for name, view in VIEWS.items()}


def register_views(obs: DataFrame, fact: str = "observations") -> list[str]:
    """Register the fact and its views for SQL; an existing view of the name is replaced."""
    frames = {fact: obs, **build_views(obs)}
    for name, frame in frames.items():
        frame.createOrReplaceTempView(name)
    return list(frames)
