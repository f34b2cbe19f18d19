from __future__ import annotations

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from conftest import hours, payload, rows, ts, write_payload
from skylog.functions import slug
from skylog.plans.export import export
from skylog.plans.load import load
from skylog.plans.transform import observations_from_payloads, transform
from skylog.plans.validate import validate
from skylog.plans.views import QUESTIONS, VIEWS, register_views
from skylog.schemas import AIR_MEASURES, FACT_COLUMNS, LOCATIONS, WEATHER_MEASURES
from skylog.sources import (
    PayloadFolder,
    locations,
    read_csv_lenient,
    read_csv_strict,
    read_fact,
    read_payloads,
    with_location,
)


def fingerprint(df):
    """Number of rows and the sum of their hashes, the same for the same rows in any order."""
    return tuple(df.agg(F.count(F.lit(1)), F.sum(F.xxhash64(*df.columns).cast("decimal(38,0)"))).first())


@pytest.fixture(scope="module")
def processed(spark, full_year, tmp_path_factory):
    weather, air = full_year
    path = str(tmp_path_factory.mktemp("processed") / "table")
    return path, transform(spark, str(weather), str(air), path, locations(spark))


def test_a_full_year_has_its_published_shape(spark, processed):
    path, result = processed
    assert rows(result.profile) == [
        (70_080, 22, 8, ts("2025-01-01T00:00"), ts("2025-12-31T23:00"), 0, 0)
    ]
    assert rows(result.rows_by_city) == sorted((city, 8760) for city, _, _ in LOCATIONS)
    assert read_fact(spark, path).columns == list(FACT_COLUMNS)


def test_a_full_year_passes_every_check(spark, processed):
    result = validate(read_fact(spark, processed[0]))
    assert (result.passed, result.failed_checks) == (True, 0)


def test_csv_output_is_the_same_data(spark, full_year, processed, tmp_path):
    path = str(tmp_path / "csv")
    transform(spark, *map(str, full_year), path, locations(spark), output_format="csv")
    parquet = read_fact(spark, processed[0])
    for df in (read_csv_strict(spark, path), read_csv_lenient(spark, path)):
        assert fingerprint(df) == fingerprint(parquet)


def test_load_views_questions_and_export(spark, processed, tmp_path):
    batch = read_fact(spark, processed[0])
    path = str(tmp_path / "fact")
    assert rows(load(batch, path).counts) == [(0, 70_080, 70_080)]
    assert rows(load(batch, path).counts) == [(70_080, 0, 70_080)]

    fact = read_fact(spark, path)
    names = register_views(fact, "observations_2025")
    assert names == ["observations_2025", *VIEWS]
    assert spark.sql("SELECT count(*) FROM observations_2025").first()[0] == 70_080
    assert spark.sql("SELECT count(*) FROM vw_monthly_air_quality").first()[0] == 96
    assert spark.sql("SELECT sum(hours) FROM vw_aqi_categories").first()[0] == 70_080

    counts = {name: question(fact).count() for name, question in QUESTIONS.items()}
    assert len(counts) == 15
    assert (counts["worst_months"], counts["worst_hours"], counts["city_rank"], counts["worst_day"]) == (20, 25, 8, 8)
    assert (counts["month_over_month"], counts["hour_by_city"], counts["monthly_trend"]) == (96, 192, 96)

    manifest = {r.source: r.rows for r in export(fact, str(tmp_path / "out")).manifest.collect()}
    assert manifest["observations"] == 70_080 and manifest["vw_daily_air_quality"] == 8 * 365


def test_the_merge_shuffles_rows_once(spark, full_year):
    weather, air = map(str, full_year)
    cities = locations(spark)
    plan = observations_from_payloads(
        read_payloads(spark, PayloadFolder(weather, WEATHER_MEASURES), cities),
        read_payloads(spark, PayloadFolder(air, AIR_MEASURES), cities),
    )
    text = plan.groupBy().agg(F.count("city"))._jdf.queryExecution().executedPlan().toString()
    assert text.count("Exchange hashpartitioning(city") == 1
    # The others deal file names or whole documents by slug, before rows are made.
    assert text.count("Exchange hashpartitioning") == 1 + text.count("Exchange hashpartitioning(slug") + text.count("Exchange hashpartitioning(_slug")


def test_location_lookup_is_broadcast_because_it_is_small(spark, processed):
    joined = with_location(read_fact(spark, processed[0]), locations(spark), "city")
    assert "BroadcastHashJoin" in joined._jdf.queryExecution().executedPlan().toString()
    assert joined.where(joined.slug != slug(joined.city)).count() == 0


def test_command_line(spark, tmp_path, capsys):
    from skylog.__main__ import main

    names = ["Denver", "New York"]
    times = hours(datetime(2025, 3, 8), 48)
    for i, name in enumerate(names):
        file = f"{name.lower().replace(' ', '_')}_2025-03-08_to_2025-03-09_20260101_000000.json"
        write_payload(tmp_path / "weather", file, payload(times, WEATHER_MEASURES, 10 + i))
        write_payload(tmp_path / "air", file, payload(times, AIR_MEASURES, 20 + i))
    listed = tmp_path / "locations.csv"
    listed.write_text("city,latitude,longitude\nDenver,39.7392,-104.9903\nNew York,40.7128,-74.0060\n")
    weather, air, table, fact = (str(tmp_path / n) for n in ("weather", "air", "table", "fact"))
    cities = ["--locations", str(listed)]
    bounds = ["--start", "2025-03-08T00:00", "--end", "2025-03-09T23:00"]

    assert main(["transform", "--weather", weather, "--air-quality", air, "--output", table, *cities], spark) == 0
    assert main(["validate", "--input", table, *cities, *bounds], spark) == 0
    assert main(["validate", "--input", table, *cities], spark) == 1
    assert main(["load", "--input", table, "--fact", fact, *cities, *bounds], spark) == 0
    assert main(["analyze", "--fact", fact, "--question", "city_rank", "vw_city_air_quality_summary"], spark) == 0
    assert main(["export", "--fact", fact, "--output", str(tmp_path / "out")], spark) == 0
    assert main(["coverage", "--payloads", weather, "--source", "weather", *cities], spark) == 0
    out = capsys.readouterr().out
    assert "failed checks: 2" in out and "aqi_rank" in out
    full = str(tmp_path / "full")
    assert main(["analyze", "--fact", fact, "--question", "hour_by_city", "--output-folder", full], spark) == 0
    assert "preview: the first 20 rows; all are in" in capsys.readouterr().out
    assert spark.read.option("header", True).csv(f"{full}/hour_by_city").count() == 48
    # The night the clocks change has all its hours.
    assert read_fact(spark, fact).count() == 96


def test_years_are_not_pooled(spark, processed):
    fact = read_fact(spark, processed[0]).where("city = 'Denver' AND month = 1")
    both = fact.unionByName(fact.withColumn("year", F.lit(2024)))
    assert {(r.year, r.month) for r in QUESTIONS["monthly_trend"](both).collect()} == {(2024, 1), (2025, 1)}
    assert {(r.year, r.month) for r in QUESTIONS["worst_months"](both).collect()} == {(2024, 1), (2025, 1)}
