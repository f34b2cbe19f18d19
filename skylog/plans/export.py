"""The export job: the fact and its views as CSV folders."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

from skylog.plans.views import build_views
from skylog.session import materialise
from skylog.sinks.csv import export_summary, export_tables

# Output name of every exported source.
OUTPUT_NAMES = {
    "observations": "hourly_observations.csv",
    "vw_city_air_quality_summary": "city_air_quality_summary.csv",
    "vw_monthly_air_quality": "monthly_air_quality.csv",
    "vw_daily_air_quality": "daily_air_quality.csv",
    "vw_hourly_patterns": "hourly_patterns.csv",
    "vw_aqi_categories": "aqi_categories.csv",
}


@dataclass(frozen=True)
class ExportResult:
    manifest: DataFrame
    summary: DataFrame


def export(obs: DataFrame, folder: str, written: bool = False) -> ExportResult:
    """Export the fact and the five views; an empty one is an error.

    Six exports read the observations. Unless they are a written table already,
    they are written to the shared folder once, so that what made them runs once.
    """
    if not written:
        obs = materialise(obs, "export")
    frames = {"observations": obs, **build_views(obs)}
    tables = {source: (frames[source], file) for source, file in OUTPUT_NAMES.items()}
    manifest = export_tables(obs.sparkSession, tables, folder)
    return ExportResult(manifest, export_summary(manifest))
