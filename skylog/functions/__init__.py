from skylog.functions.bands import (
    AQI_CATEGORIES,
    AQI_RANGES,
    TEMPERATURE_BANDS,
    WIND_BANDS,
    Bands,
    rain_label,
)
from skylog.functions.numeric import count_rows, mean, peak, percentage, round2, total, without_nan
from skylog.functions.text import slug
from skylog.functions.time import parse_timestamp, wall_clock, with_calendar

__all__ = [
    "AQI_CATEGORIES",
    "AQI_RANGES",
    "TEMPERATURE_BANDS",
    "WIND_BANDS",
    "Bands",
    "count_rows",
    "mean",
    "parse_timestamp",
    "peak",
    "percentage",
    "rain_label",
    "round2",
    "slug",
    "total",
    "wall_clock",
    "with_calendar",
    "without_nan",
]
