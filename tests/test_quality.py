from __future__ import annotations

from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from conftest import rows, ts
from skylog.functions import with_calendar
from skylog.operators import quality
from skylog.plans.validate import QualityError, require_quality, validate
from skylog.schemas import FACT_COLUMNS, MEASURES, OBSERVATION

EXPECTED = quality.Expectations(cities=("a", "b"), start=ts("2025-01-01T00:00"), end=ts("2025-01-01T02:00"))


def good(spark):
    data = [
        (c, ts("2025-01-01T00:00") + timedelta(hours=h), *[float(h + 1)] * len(MEASURES))
        for c in "ab"
        for h in range(3)
    ]
    names = ", ".join(f"{m} double" for m in MEASURES)
    df = spark.createDataFrame(data, f"city string, timestamp timestamp_ntz, {names}")
    df = df.withColumn("weather_code", F.col("weather_code").cast("int"))
    return with_calendar(df).select(*FACT_COLUMNS)


def failures(df, expected=EXPECTED):
    return {r.check: r.violations for r in quality.quality_report(df, expected).collect() if not r.passed}


def first_hour(column, value):
    return F.when((F.col("city") == "a") & (F.col("hour") == 0), value).otherwise(F.col(column))


def test_good_data_passes_everything(spark):
    report = quality.quality_report(good(spark), EXPECTED).collect()
    assert len(report) == 1 + 3 + 3 + 2 + 9 and all(r.passed for r in report)
    assert rows(quality.verdict(quality.quality_report(good(spark), EXPECTED))) == [(True, 0)]
    assert len(require_quality(good(spark), EXPECTED)) == 18


def test_missing_columns_end_the_report(spark):
    df = good(spark).drop("ozone", "hour")
    assert rows(quality.quality_report(df, EXPECTED)) == [("required_columns", 2, False)]
    result = validate(df, EXPECTED)
    assert (result.passed, result.failed_checks) == (False, 1) and result.missing_values is None


def test_cities(spark):
    df = good(spark).withColumn("city", F.when(F.col("city") == "b", "z").otherwise(F.col("city")))
    assert failures(df) == {"missing_cities": 1, "unexpected_cities": 1}
    assert rows(quality.missing_cities(df, EXPECTED)) == [("b",)]
    assert rows(quality.unexpected_cities(df, EXPECTED)) == [("z",)]


def test_null_city_is_not_unexpected(spark):
    df = good(spark).withColumn("city", first_hour("city", F.lit(None)))
    assert "unexpected_cities" not in failures(df)


def test_repeated_keys_count_all_their_rows(spark):
    df = good(spark)
    assert failures(df.unionByName(df.where("city = 'a' AND hour = 1"))) == {"unique_keys": 2}


def test_invalid_timestamps_and_bounds(spark):
    df = good(spark).withColumn("timestamp", F.when(F.col("hour") > 0, F.col("timestamp")))
    assert failures(df) == {"valid_timestamps": 2, "starts_as_expected": 1}
    longer = quality.Expectations(cities=("a", "b"), start=EXPECTED.start, end=ts("2025-01-01T03:00"))
    assert failures(good(spark), longer) == {"ends_as_expected": 1}


@pytest.mark.parametrize(
    ("column", "value", "check"),
    [
        ("relative_humidity_2m", 100.5, "percent_relative_humidity_2m"),
        ("relative_humidity_2m", -0.5, "percent_relative_humidity_2m"),
        ("cloud_cover", 101.0, "percent_cloud_cover"),
        ("precipitation", -0.1, "non_negative_precipitation"),
        ("us_aqi", -1.0, "non_negative_us_aqi"),
    ],
)
def test_values_out_of_range(spark, column, value, check):
    assert failures(good(spark).withColumn(column, first_hour(column, F.lit(value)))) == {check: 1}


def test_missing_values_pass_the_range_checks(spark):
    df = good(spark).withColumn("us_aqi", first_hour("us_aqi", F.lit(None).cast("double")))
    assert failures(df) == {}
    assert rows(quality.null_profile(df)) == [("us_aqi", 1, 16.67)]


def test_require_quality_raises(spark):
    df = good(spark).withColumn("ozone", first_hour("ozone", F.lit(-1.0)))
    with pytest.raises(QualityError, match=r"non_negative_ozone \(1\)"):
        require_quality(df, EXPECTED)


def test_validate_informs(spark):
    result = validate(good(spark), EXPECTED)
    assert rows(result.rows_by_city) == [("a", 3), ("b", 3)]
    assert rows(result.missing_cities) == rows(result.unexpected_cities) == rows(result.missing_values) == []


def test_duplicates_are_counted_three_ways(spark):
    df = spark.createDataFrame([("a", 1)] * 3 + [("b", 1)], "city string, timestamp int")
    assert rows(quality.duplicate_stats(df)) == [(1, 2, 3)]
    nulls = spark.createDataFrame([(None, None)] * 2, "city string, timestamp int")
    assert rows(quality.duplicate_stats(nulls)) == [(1, 1, 2)]


def test_profile(spark):
    df = good(spark).withColumn("ozone", F.when(F.col("hour") == 0, F.col("ozone")))
    df = df.unionByName(df.where("city = 'a' AND hour = 1"))
    assert rows(quality.dataset_profile(df)) == [
        (7, 22, 2, ts("2025-01-01T00:00"), ts("2025-01-01T02:00"), 1, 5)
    ]


def test_empty_input(spark):
    empty = spark.createDataFrame([], OBSERVATION)
    assert rows(quality.dataset_profile(empty)) == [(0, 22, 0, None, None, 0, 0)]
    assert rows(quality.duplicate_stats(empty)) == [(0, 0, 0)]
    assert rows(quality.null_profile(empty)) == []
    assert rows(quality.rows_by_city(empty)) == []
    assert failures(empty) == {"missing_cities": 2, "starts_as_expected": 1, "ends_as_expected": 1}


def test_rows_by_city_leaves_out_unknown_cities(spark):
    df = spark.createDataFrame([("b",), ("a",), ("b",), (None,)], "city string")
    assert rows(quality.rows_by_city(df)) == [("a", 1), ("b", 2)]


def test_constraints_name_every_broken_rule(spark):
    df = good(spark).withColumns(
        {
            "ozone": first_hour("ozone", F.lit(-1.0)),
            "month": first_hour("month", F.lit(13)),
            "us_aqi": first_hour("us_aqi", F.lit(None).cast("double")),
        }
    )
    df = df.withColumn("city", F.when((F.col("city") == "b") & (F.col("hour") == 2), F.repeat(F.lit("b"), 101)).otherwise(F.col("city")))
    df = df.withColumn("day", F.when((F.col("city") == "b") & (F.col("hour") == 1), F.lit(None)).otherwise(F.col("day")))
    valid, broken = quality.split_by_rules(df)
    assert valid.count() == 3 and valid.columns == list(FACT_COLUMNS)
    assert sorted(tuple(r.broken_rules) for r in broken.collect()) == [
        ("city longer than 100",),
        ("day is null",),
        ("ozone negative", "month outside 1..12", "month is not that of timestamp"),
    ]


def test_rows_are_judged_once(spark):
    texts = spark.createDataFrame([('{"a": 1, "b": -1}',), ('{"a": -1}',), ('{"a": 5, "b": 7}',)], "raw string")
    df = texts.select(*[F.get_json_object("raw", f"$.{c}").cast("int").alias(c) for c in "ab"])
    rules = {f"{c} {n}": bad for c in "ab" for n, bad in (("negative", F.col(c) < 0), ("null", F.col(c).isNull()), ("large", F.col(c) > 9))}
    judged = quality.with_broken_rules(df, rules)._jdf.queryExecution().optimizedPlan().toString()
    assert judged.count("get_json_object") == 2
    valid, broken = quality.split_by_rules(df.withColumn("_refused", F.lit(1)), rules)
    assert rows(valid) == [(5, 7, 1)]
    assert sorted(map(str, rows(broken.select("a", "b", "broken_rules")))) == ["(-1, None, ['a negative', 'b null'])", "(1, -1, ['b negative'])"]
    for half in (valid, broken):
        assert "PartitionFilters: [isnotnull(__refused" in half._jdf.queryExecution().executedPlan().toString()


def test_validation_reads_cities_from_their_counts(spark):
    df = spark.createDataFrame([("a", None, 1.0), ("b", None, None), (None, None, 1.0)], "city string, timestamp timestamp_ntz, v double")
    expected = quality.Expectations(cities=("a", "c"), start=None, end=None, columns=("city", "v"), percent=("v",), non_negative=())
    result = validate(df, expected)
    assert {r.check: r.violations for r in result.report} == {
        r.check: r.violations for r in quality.quality_report(df, expected).collect()
    }
    assert rows(result.missing_cities) == [("c",)] and rows(result.unexpected_cities) == [("b",)]
    assert rows(result.rows_by_city) == [("a", 1), ("b", 1)]
    assert rows(result.missing_values) == rows(quality.null_profile(df))
    assert "city-counts" in result.unexpected_cities.inputFiles()[0]


def test_load_check(spark):
    df = good(spark)
    assert quality.load_check(df, 6, 2).first().passed
    assert not quality.load_check(df, 5, 2).first().passed
    assert not quality.load_check(df, 6, 3).first().passed
    twice = quality.load_check(df.unionByName(df), 12, 2).first()
    assert (twice.duplicate_groups, twice.passed) == (6, False)
