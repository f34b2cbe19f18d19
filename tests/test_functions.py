from __future__ import annotations

from decimal import ROUND_HALF_UP, Decimal

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from conftest import rows, ts
from skylog.functions import (
    AQI_CATEGORIES,
    TEMPERATURE_BANDS,
    WIND_BANDS,
    Bands,
    parse_timestamp,
    percentage,
    rain_label,
    round2,
    slug,
    with_calendar,
    without_nan,
)


def labels(spark, bands, values):
    df = spark.createDataFrame([(v,) for v in values], "x double")
    return [r[0] for r in df.select(bands.label("x")).collect()]


def test_band_edges_belong_to_the_upper_band(spark):
    assert labels(spark, WIND_BANDS, [4.99, 5.0, 10.0, 15.0, 20.0]) == ["0-5", "5-10", "10-15", "15-20", "20+"]
    assert labels(spark, TEMPERATURE_BANDS, [31.9, 32.0, 50.0, 68.0, 86.0]) == list(TEMPERATURE_BANDS.labels)


def test_category_edges_belong_to_the_lower_category(spark):
    assert labels(spark, AQI_CATEGORIES, [50.0, 100.0, 150.0, 200.0, 300.0, 300.5]) == list(AQI_CATEGORIES.labels)
    df = spark.createDataFrame([(50.5,), (100.5,), (150.5,), (200.5,), (300.5,)], "x double")
    assert [r[0] for r in df.select(AQI_CATEGORIES.order("x")).collect()] == [2, 3, 4, 5, 6]


def test_null_falls_into_the_last_band(spark):
    assert labels(spark, WIND_BANDS, [None]) == ["20+"]
    assert labels(spark, TEMPERATURE_BANDS, [None]) == ["86 F and above"]
    assert labels(spark, AQI_CATEGORIES, [None]) == ["Hazardous"]
    dry = spark.createDataFrame([(None,), (0.0,), (0.1,)], "x double").select(rain_label("x"))
    assert [r[0] for r in dry.collect()] == ["Dry", "Dry", "Rain / Precipitation"]


def test_bands_must_be_consistent():
    with pytest.raises(ValueError):
        Bands((1, 2), ("a", "b"))
    with pytest.raises(ValueError):
        Bands((2, 1), ("a", "b", "c"))


def test_round2_is_half_away_from_zero(spark):
    df = spark.createDataFrame([(70.695,), (-70.695,), (0.005,), (141.39000000000001 / 2,), (None,)], "x double")
    assert [r[0] for r in df.select(round2(F.col("x"))).collect()] == [70.7, -70.7, 0.01, 70.7, None]


def test_round2_of_large_values(spark):
    df = spark.createDataFrame([(1.5e16,), (-3e300,), (float("nan"),)], "x double")
    assert [str(r[0]) for r in df.select(round2(F.col("x"))).collect()] == ["1.5e+16", "-3e+300", "nan"]


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.floats(-1e6, 1e6, allow_nan=False), min_size=1, max_size=60))
def test_round2_matches_decimal_arithmetic(spark, values):
    df = spark.createDataFrame(list(enumerate(values)), "i int, x double").select("i", round2(F.col("x")).alias("r"))
    got = {r.i: r.r for r in df.collect()}
    twelve, two = Decimal("1e-12"), Decimal("0.01")
    for i, v in enumerate(values):
        want = Decimal(repr(v)).quantize(twelve, ROUND_HALF_UP).quantize(two, ROUND_HALF_UP)
        assert got[i] == float(want)


def test_percentage_of_nothing_is_null(spark):
    df = spark.createDataFrame([(1, 3), (0, 0)], "a bigint, b bigint")
    assert [r[0] for r in df.select(percentage(F.col("a"), F.col("b"))).collect()] == [33.33, None]


def test_hours_skipped_by_daylight_saving_stay(spark):
    texts = ["2025-03-09T01:00", "2025-03-09T02:00", "2025-03-09T03:00"]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select(parse_timestamp(F.col("t")).alias("timestamp"))
    got = with_calendar(df).orderBy("timestamp").collect()
    assert [r.timestamp for r in got] == [ts(t) for t in texts]
    assert [r.hour for r in got] == [1, 2, 3]
    assert {r.day_of_week for r in got} == {"Sunday"}


def test_bad_timestamps_are_null(spark):
    df = spark.createDataFrame([("junk",), (None,), ("2025-01-01T00:00",)], "t string")
    assert rows(df.select(parse_timestamp(F.col("t")))) == [(None,), (None,), (ts("2025-01-01T00:00"),)]


def test_calendar(spark):
    df = spark.createDataFrame([(ts("2025-01-01T23:00"),), (None,)], "timestamp timestamp_ntz")
    first, empty = with_calendar(df).collect()
    assert (str(first.date), first.year, first.month, first.day, first.hour, first.day_of_week) == (
        "2025-01-01", 2025, 1, 1, 23, "Wednesday",
    )
    assert set(empty) == {None}
    # The optimizer must not take the day name of a null date to be known.
    assert with_calendar(df).where("day_of_week IS NULL").count() == 1


def test_slug(spark):
    df = spark.createDataFrame([("Salt Lake City",), ("Denver",)], "c string")
    assert rows(df.select(slug(F.col("c")))) == [("salt_lake_city",), ("denver",)]


def test_nan_becomes_null_and_is_above_no_threshold(spark):
    df = spark.createDataFrame([(float("nan"), 1), (150.0, 2)], "x double, n int")
    clean = without_nan(df)
    assert rows(clean) == [(None, 1), (150.0, 2)]
    assert clean.where("x > 100").count() == 1
