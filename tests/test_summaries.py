from __future__ import annotations

import random
from collections import defaultdict
from datetime import timedelta

from pyspark.sql import functions as F

from conftest import rows, ts
from skylog.functions import rain_label, with_calendar
from skylog.functions.bands import WIND_BANDS
from skylog.operators import rankings, summaries

SCHEMA = """city string, timestamp timestamp_ntz, us_aqi double, pm2_5 double, pm10 double, ozone double,
    temperature_2m double, relative_humidity_2m double, wind_speed_10m double, precipitation double"""


def obs(spark, *levels, start="2025-01-01T00:00", city="x", step=timedelta(hours=1)):
    first = ts(start)
    data = [(city, first + i * step, v, 1.0, 2.0, 3.0, 40.0, 50.0, 6.0, 0.0) for i, v in enumerate(levels)]
    return with_calendar(spark.createDataFrame(data, SCHEMA))


def test_null_level_is_hazardous_in_the_view_and_nowhere_in_the_ranges(spark):
    df = obs(spark, None)
    assert rows(summaries.category_distribution(df)) == [("x", "Hazardous", 6, 1, 100.0)]
    assert rows(summaries.hours_per_range(df)) == [("x", 0, 0, 0, 0, 0, 0)]


def test_values_between_two_ranges_count_nowhere(spark):
    df = obs(spark, 50.5, 100.5, 150.5, 200.5, 300.5)
    assert rows(summaries.hours_per_range(df)) == [("x", 0, 0, 0, 0, 0, 1)]
    assert sorted(r.category_order for r in summaries.category_distribution(df).collect()) == [2, 3, 4, 5, 6]


def test_range_edges(spark):
    df = obs(spark, 50.0, 51.0, 100.0, 101.0, 150.0, 151.0, 200.0, 201.0, 300.0, 301.0)
    assert rows(summaries.hours_per_range(df)) == [("x", 1, 2, 2, 2, 2, 1)]


def test_category_share_is_of_the_group(spark):
    df = obs(spark, 10.0, 20.0, 60.0).unionByName(obs(spark, 400.0, city="y"))
    got = {(r.city, r.aqi_category): (r.hours, r.pct_city_hours) for r in summaries.category_distribution(df).collect()}
    assert got == {("x", "Good"): (2, 66.67), ("x", "Moderate"): (1, 33.33), ("y", "Hazardous"): (1, 100.0)}


def test_summary_ignores_missing_levels_but_counts_the_hours(spark):
    got = summaries.group_summary(obs(spark, 100.0, 101.0, None, 103.0)).first()
    assert (got.hourly_observations, got.avg_aqi, got.max_aqi) == (4, 101.33, 103.0)
    assert (got.hours_above_aqi_100, got.pct_hours_above_aqi_100) == (2, 50.0)


def test_threshold_is_a_parameter(spark):
    got = summaries.exceedance(obs(spark, 10.0, 35.0, 36.5), threshold=35.5).first()
    assert got.asDict() == {"city": "x", "total_hours": 3, "hours_above_35_5": 1, "pct_hours_above_35_5": 33.33}


def test_group_without_any_level_comes_first(spark):
    df = obs(spark, 10.0, city="a").unionByName(obs(spark, None, city="b")).unionByName(obs(spark, 20.0, city="c"))
    assert [r.city for r in summaries.overview(df).collect()] == ["b", "c", "a"]
    assert [r.city for r in rankings.worst_hours(df, limit=2).collect()] == ["b", "c"]


def test_bands_are_ordered_by_their_lowest_value(spark):
    winds = [22.0, 3.0, 12.0, None]
    df = obs(spark, 0.0, 1.0, 2.0, 3.0)
    df = df.withColumn("wind_speed_10m", F.element_at(F.array(*map(F.lit, winds)), F.col("hour") + 1))
    got = summaries.by_band(df, "wind_speed_10m", WIND_BANDS, "wind_speed_group").collect()
    assert [(r.wind_speed_group, r.observations) for r in got] == [("0-5", 1), ("10-15", 1), ("20+", 2)]
    assert "_lowest" not in got[0].asDict()


def test_conditions(spark):
    got = summaries.by_condition(obs(spark, 1.0, 2.0), rain_label("precipitation"), "weather_condition").collect()
    assert [(r.weather_condition, r.observations, r.avg_aqi) for r in got] == [("Dry", 2, 1.5)]


def test_summaries_match_brute_force(spark):
    rng = random.Random(3)
    data = [
        (c, ts("2025-01-30T00:00") + timedelta(hours=h), round(rng.uniform(0, 400), 1), 1.0, 2.0, 3.0, 4.0, 5.0, 6.0, 0.25)
        for c in "ab"
        for h in range(100)
    ]
    df = with_calendar(spark.createDataFrame(data, SCHEMA))
    by_day = defaultdict(list)
    for row in data:
        by_day[row[0], row[1].date()].append(row[2])
    got = {(r.city, r.date): r for r in summaries.daily_summary(df).collect()}
    assert got.keys() == by_day.keys()
    for key, levels in by_day.items():
        assert got[key].hourly_observations == len(levels)
        assert abs(got[key].avg_aqi - sum(levels) / len(levels)) <= 0.005001
        assert got[key].max_aqi == max(levels)
        assert got[key].total_precipitation == 0.25 * len(levels)


def test_empty_input_gives_empty_results(spark):
    empty = obs(spark, 1.0).where("false")
    for view in (
        summaries.group_summary,
        summaries.monthly_summary,
        summaries.daily_summary,
        summaries.hourly_pattern,
        summaries.category_distribution,
        summaries.overview,
        summaries.hours_per_range,
        rankings.rank_groups,
        rankings.worst_periods,
        rankings.worst_hours,
        rankings.period_change,
        rankings.worst_period_per_group,
    ):
        assert rows(view(empty)) == []


# --- rankings --------------------------------------------------------------------


def test_lag_takes_the_previous_month_present(spark):
    df = obs(spark, 10.0, start="2025-01-01T00:00")
    for month, level in ((2, 20.0), (4, 35.0)):
        df = df.unionByName(obs(spark, level, start=f"2025-{month:02d}-01T00:00"))
    assert rows(rankings.period_change(df)) == [
        ("x", 2025, 1, 10.0, None, None),
        ("x", 2025, 2, 20.0, 10.0, 10.0),
        ("x", 2025, 4, 35.0, 20.0, 15.0),
    ]


def test_lag_crosses_the_year(spark):
    df = obs(spark, 10.0, start="2024-12-01T00:00").unionByName(obs(spark, 4.0, start="2025-01-01T00:00"))
    assert [r.aqi_change for r in rankings.period_change(df).collect()] == [None, -6.0]


def test_worst_day_goes_to_the_earliest_of_equals(spark):
    df = obs(spark, 5.0, 9.0, 9.0, step=timedelta(days=1))
    assert [(str(r.date), r.avg_aqi) for r in rankings.worst_period_per_group(df).collect()] == [("2025-01-02", 9.0)]


def test_worst_periods_break_ties_by_key(spark):
    df = obs(spark, 5.0, city="b").unionByName(obs(spark, 5.0, city="a")).unionByName(obs(spark, 7.0, city="c"))
    assert [r.city for r in rankings.worst_periods(df, limit=2).collect()] == ["c", "a"]


def test_equal_averages_share_a_rank(spark):
    levels = {"a": 5.0, "b": 7.25, "c": 5.0, "d": 5.5, "e": None, "f": 0.5}
    df = None
    for city, level in levels.items():
        one = obs(spark, level, city=city)
        df = one if df is None else df.unionByName(one)
    got = {r.city: r.aqi_rank for r in rankings.rank_groups(df).collect()}
    assert got == {"e": 1, "b": 2, "d": 3, "a": 4, "c": 4, "f": 6}


def test_rank_matches_brute_force(spark):
    rng = random.Random(11)
    start = ts("2025-01-01T00:00")
    levels = {f"c{i:03d}": rng.choice([rng.uniform(-20, 500), 77.5, 77.25]) for i in range(300)}
    data = [(c, start, v, 1.0, 2.0, 3.0, 4.0, 5.0, 6.0, 0.0) for c, v in levels.items()]
    df = with_calendar(spark.createDataFrame(data, SCHEMA))
    want = {c: 1 + sum(w > v for w in levels.values()) for c, v in levels.items()}
    ranked = rankings.rank_groups(df)
    assert {r.city: r.aqi_rank for r in ranked.collect()} == want
    assert [c for c in ranked.columns] == ["aqi_rank", "city", "avg_aqi", "avg_pm2_5", "avg_pm10"]


def test_rank_reads_its_input_once_and_writes_nothing(spark, tmp_path):
    from pathlib import Path

    obs(spark, 5.0, city="a").unionByName(obs(spark, None, city="b")).unionByName(obs(spark, float("nan"), city="c")).unionByName(
        obs(spark, 1e16, 3.0, city="d")
    ).write.parquet(str(tmp_path / "obs"))
    shared = Path(spark.conf.get("spark.checkpoint.dir").removeprefix("file:"))
    before = set(shared.glob("*"))
    read = spark.read.parquet(str(tmp_path / "obs"))
    ranked = rankings.rank_groups(read)
    assert {r.city: r.aqi_rank for r in ranked.collect()} == {"b": 1, "c": 2, "d": 3, "a": 4}
    assert set(shared.glob("*")) == before
    final = ranked._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert "CartesianProduct" not in final and "NestedLoop" not in final and final.count("FileScan") == 1
    assert rankings.rank_groups(read.limit(0)).collect() == []


def test_scratch_tables_can_be_dropped(spark):
    from pathlib import Path

    from skylog.session import drop_scratch, materialise

    shared = Path(spark.conf.get("spark.checkpoint.dir").removeprefix("file:"))
    drop_scratch(spark)
    before = set(shared.glob("*"))
    written = [materialise(spark.range(n), "counted") for n in (2, 3)]
    assert [w.count() for w in written] == [2, 3] and len(set(shared.glob("*")) - before) == 2
    drop_scratch(spark)
    assert set(shared.glob("*")) == before
