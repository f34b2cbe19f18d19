"""Column names, types, rules and locations of the observation fact.

Everything that reads or writes observations takes its schema from here; no
read infers types.
"""

from __future__ import annotations

from pyspark.sql import types as T

KEY = ("city", "timestamp")

# Payload variables and fact columns.
WEATHER_MEASURES = (
    "temperature_2m",
    "relative_humidity_2m",
    "precipitation",
    "wind_speed_10m",
    "surface_pressure",
    "cloud_cover",
    "weather_code",
)
AIR_MEASURES = (
    "pm2_5",
    "pm10",
    "carbon_monoxide",
    "nitrogen_dioxide",
    "sulphur_dioxide",
    "ozone",
    "us_aqi",
)
CALENDAR = ("date", "year", "month", "day", "hour", "day_of_week")

MEASURES = WEATHER_MEASURES + AIR_MEASURES
FACT_COLUMNS = KEY + MEASURES + CALENDAR
FACT_PARTITIONS = ("year", "month")

# The ranges a measure must keep to; a null always passes.
PERCENT_MEASURES = ("relative_humidity_2m", "cloud_cover")
NON_NEGATIVE_MEASURES = ("precipitation", "wind_speed_10m") + AIR_MEASURES
CALENDAR_RANGES = {"month": (1, 12), "day": (1, 31), "hour": (0, 23)}
MAX_LENGTHS = {"city": 100, "day_of_week": 20}
NOT_NULL_COLUMNS = KEY + CALENDAR

_TYPES: dict[str, T.DataType] = {
    "city": T.StringType(),
    "timestamp": T.TimestampNTZType(),
    **{name: T.DoubleType() for name in MEASURES},
    "weather_code": T.IntegerType(),
    "date": T.DateType(),
    "year": T.IntegerType(),
    "month": T.IntegerType(),
    "day": T.IntegerType(),
    "hour": T.IntegerType(),
    "day_of_week": T.StringType(),
}


def column_type(name: str) -> T.DataType:
    """Type of a fact column; a column the fact does not know is text."""
    return _TYPES.get(name, T.StringType())


OBSERVATION = T.StructType([T.StructField(c, _TYPES[c]) for c in FACT_COLUMNS])

LOCATION = T.StructType(
    [
        T.StructField("city", T.StringType(), False),
        T.StructField("latitude", T.DoubleType(), False),
        T.StructField("longitude", T.DoubleType(), False),
    ]
)

# The configured locations.
LOCATIONS = (
    ("Salt Lake City", 40.7608, -111.8910),
    ("Denver", 39.7392, -104.9903),
    ("Los Angeles", 34.0522, -118.2437),
    ("Seattle", 47.6062, -122.3321),
    ("Chicago", 41.8781, -87.6298),
    ("New York", 40.7128, -74.0060),
    ("Houston", 29.7604, -95.3698),
    ("Phoenix", 33.4484, -112.0740),
)


def payload_schema(measures: tuple[str, ...]) -> T.StructType:
    """Schema of one payload document: a struct of parallel hourly arrays.

    Every measure is read as double, integer codes included, because a source
    may print them as ``3.0``; the fact type is applied when rows are made.
    """
    arrays = [T.StructField("time", T.ArrayType(T.StringType()))]
    arrays += [T.StructField(m, T.ArrayType(T.DoubleType())) for m in measures]
    return T.StructType([T.StructField("hourly", T.StructType(arrays))])
