from __future__ import annotations

import os
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from conftest import hours, payload, rows, ts, write_payload
from skylog.plans.transform import ingestion_coverage, source_rows
from skylog.operators.joins import coverage_totals
from skylog.schemas import AIR_MEASURES, WEATHER_MEASURES
from skylog.sources import (
    PayloadFolder,
    explode_payloads,
    fill_null_arrays,
    landed_files,
    latest_files,
    locations,
    parse_payloads,
    payload_problems,
    read_payloads,
    split_file_name,
)
from skylog.sources import payloads
from skylog.sources.payloads import RECENT_NAME

TIMES = hours(datetime(2025, 1, 1), 3)


def texts(spark, *documents):
    import json

    data = [(f"c{i}", d if isinstance(d, str) else json.dumps(d)) for i, d in enumerate(documents)]
    return spark.createDataFrame(data, "city string, raw string")


def cities(spark, *names):
    return locations(spark, [(n, 0.0, 0.0) for n in names])


def test_file_names(spark):
    names = [
        "salt_lake_city_2025-01-01_to_2025-12-31_20260101_060000.json",
        "denver_20260101_060000.json",
        "notes.json",
    ]
    df = spark.createDataFrame([(n,) for n in names], "n string")
    assert rows(df.select(*split_file_name(F.col("n")))) == [
        ("salt_lake_city", "20260101_060000"),
        (None, None),
        (None, None),
    ]
    assert rows(df.select(*split_file_name(F.col("n"), RECENT_NAME))) == [
        (None, None),
        ("denver", "20260101_060000"),
        (None, None),
    ]


def test_newest_run_of_each_city_by_full_slug(spark, tmp_path):
    run = "2025-01-01_to_2025-01-01"
    old = write_payload(tmp_path, f"york_{run}_20260101_000000.json", payload(TIMES, AIR_MEASURES, 1))
    new = write_payload(tmp_path, f"york_{run}_20250101_000000.json", payload(TIMES, AIR_MEASURES, 2))
    north = write_payload(tmp_path, f"york_north_{run}_20270101_000000.json", payload(TIMES, AIR_MEASURES, 3))
    os.utime(old, (1_000_000_000, 1_000_000_000))
    os.utime(new, (1_100_000_000, 1_100_000_000))
    os.utime(north, (1_200_000_000, 1_200_000_000))
    folder = PayloadFolder(str(tmp_path), AIR_MEASURES)

    newest = {r.slug: r.path.split("/")[-1] for r in latest_files(landed_files(spark, folder)).collect()}
    assert newest == {"york": new.name, "york_north": north.name}

    read = read_payloads(spark, folder, cities(spark, "York", "York North"))
    values = {r.city: r.hourly.pm2_5[0] for r in read.collect()}
    assert values == {"York": 2.0, "York North": 3.0}


def test_unusual_city_names(spark, tmp_path):
    names = ["Zürich", "St. John's", "Foz do Iguaçu 100%", "A+B %41"]
    for i, name in enumerate(names):
        file = f"{name.lower().replace(' ', '_')}_2025-01-01_to_2025-01-01_20260101_000000.json"
        write_payload(tmp_path, file, payload(TIMES, AIR_MEASURES, i))
    folder = PayloadFolder(str(tmp_path), AIR_MEASURES)
    read = read_payloads(spark, folder, cities(spark, *names))
    assert {r.city: r.hourly.pm2_5[0] for r in read.collect()} == {n: float(i) for i, n in enumerate(names)}
    report = ingestion_coverage(spark, folder, cities(spark, *names))
    assert sorted(rows(report)) == sorted((n, True, 3, True) for n in names)


def test_same_modification_time_goes_by_run_stamp(spark, tmp_path):
    for stamp in ("20260101_000000", "20260102_000000"):
        path = write_payload(tmp_path, f"york_2025-01-01_to_2025-01-01_{stamp}.json", payload(TIMES, AIR_MEASURES))
        os.utime(path, (1_000_000_000, 1_000_000_000))
    newest = latest_files(landed_files(spark, PayloadFolder(str(tmp_path), AIR_MEASURES))).collect()
    assert [r.run_stamp for r in newest] == ["20260102_000000"]


def test_recent_runs_are_a_kind_of_their_own(spark, tmp_path):
    write_payload(tmp_path, "york_20260101_000000.json", payload(TIMES, WEATHER_MEASURES, 5))
    write_payload(tmp_path, "york_2025-01-01_to_2025-01-01_20270101_000000.json", payload(TIMES, WEATHER_MEASURES, 9))
    folder = PayloadFolder(str(tmp_path), WEATHER_MEASURES, recent=True)
    read = read_payloads(spark, folder, cities(spark, "York")).collect()
    assert [r.hourly.temperature_2m[0] for r in read] == [5.0]


def test_city_without_payload_is_an_error(spark, tmp_path):
    write_payload(tmp_path, "york_2025-01-01_to_2025-01-01_20260101_000000.json", payload(TIMES, AIR_MEASURES))
    with pytest.raises(FileNotFoundError, match="Leeds"):
        read_payloads(spark, PayloadFolder(str(tmp_path), AIR_MEASURES), cities(spark, "York", "Leeds"))


def test_rows_of_a_payload(spark):
    parsed = parse_payloads(texts(spark, payload(TIMES, WEATHER_MEASURES, 1)), WEATHER_MEASURES)
    got = source_rows(parsed, WEATHER_MEASURES).orderBy("timestamp")
    assert got.columns == ["city", "timestamp", *WEATHER_MEASURES]
    assert dict(got.dtypes)["weather_code"] == "int"
    assert rows(got.select("timestamp", "temperature_2m", "weather_code")) == [
        (ts("2025-01-01T00:00"), 1.0, 0),
        (ts("2025-01-01T01:00"), 1.1, 1),
        (ts("2025-01-01T02:00"), 1.2, 2),
    ]


def test_codes_printed_as_decimals_and_missing_values(spark):
    document = payload(TIMES, WEATHER_MEASURES)
    document["hourly"]["weather_code"] = [1, None, 3.0]
    parsed = parse_payloads(texts(spark, document), WEATHER_MEASURES)
    got = source_rows(parsed, WEATHER_MEASURES).orderBy("timestamp")
    assert [r.weather_code for r in got.collect()] == [1, None, 3]


def test_arrays_of_unequal_length_are_refused(spark):
    document = payload(TIMES, AIR_MEASURES)
    document["hourly"]["ozone"].pop()
    parsed = parse_payloads(texts(spark, document), AIR_MEASURES)
    assert rows(payload_problems(parsed, AIR_MEASURES)) == [("c0", "length", "ozone")]
    with pytest.raises(Exception, match="differ in length"):
        explode_payloads(parsed, AIR_MEASURES).collect()


def test_absent_and_null_arrays_are_told_apart(spark):
    absent, null = payload(TIMES, AIR_MEASURES), payload(TIMES, AIR_MEASURES)
    del absent["hourly"]["ozone"]
    null["hourly"]["ozone"] = None
    no_time = payload(TIMES, AIR_MEASURES)
    del no_time["hourly"]["time"]
    documents = [absent, null, {"x": 1}, {"hourly": None}, no_time, payload(TIMES, AIR_MEASURES)]
    parsed = parse_payloads(texts(spark, *documents), AIR_MEASURES)
    assert sorted(rows(payload_problems(parsed, AIR_MEASURES))) == [
        ("c0", "missing", "ozone"),
        ("c1", "null", "ozone"),
        ("c2", "missing", "hourly"),
        ("c3", "null", "hourly"),
        ("c4", "missing", "time"),
    ]
    for city in ("c0", "c1", "c2", "c3", "c4"):
        with pytest.raises(Exception, match="lacks a required array: " + city):
            explode_payloads(parsed.where(f"city = '{city}'"), AIR_MEASURES).collect()


def test_null_arrays_can_be_kept_as_missing_values(spark):
    absent, null = payload(TIMES, AIR_MEASURES), payload(TIMES, AIR_MEASURES)
    del absent["hourly"]["ozone"]
    null["hourly"]["ozone"] = None
    parsed = parse_payloads(texts(spark, null), AIR_MEASURES)
    got = source_rows(parsed, AIR_MEASURES, null_arrays="keep").collect()
    assert len(got) == 3 and {r.ozone for r in got} == {None}
    with pytest.raises(Exception, match="lacks a required array"):
        source_rows(parse_payloads(texts(spark, absent), AIR_MEASURES), AIR_MEASURES, null_arrays="keep").collect()
    assert fill_null_arrays(parsed, AIR_MEASURES).first().hourly.ozone == [None] * 3


def test_text_that_is_not_json_is_an_error(spark):
    with pytest.raises(Exception):
        parse_payloads(texts(spark, "{not json"), AIR_MEASURES).collect()


def opened(spark, df) -> tuple[list, int]:
    """The rows of a frame, and how many files its scan of texts opened."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        found = df.collect()
        leaves = df._jdf.queryExecution().executedPlan().collectLeaves()
        scans = [leaves.apply(i) for i in range(leaves.size())]
        return found, sum(s.metrics().apply("numFiles").value() for s in scans if "FileScan text" in s.toString())
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")


@pytest.mark.parametrize("by_run", [False, True])
@pytest.mark.parametrize("named", [1000, 1])
def test_only_the_newest_runs_are_read(spark, tmp_path, monkeypatch, by_run, named):
    monkeypatch.setattr(payloads, "NAMED", named)
    for run in range(10):
        stamp = f"20260101_00000{run}"
        for i, slug in enumerate(("york", "hull+x y")):
            place = tmp_path / f"run={stamp}" if by_run else tmp_path
            path = write_payload(place, f"{slug}_2025-01-01_to_2025-01-01_{stamp}.json", payload(TIMES, AIR_MEASURES, run + 100 * i))
            os.utime(path, (1_000_000 + run, 1_000_000 + run))
    folder = PayloadFolder(str(tmp_path), AIR_MEASURES)
    both = spark.createDataFrame([("York", "york"), ("Hull", "hull+x y")], "city string, slug string")
    found, files = opened(spark, read_payloads(spark, folder, both))
    assert sorted((r.city, r.hourly[AIR_MEASURES[0]][0]) for r in found) == [("Hull", 109.0), ("York", 9.0)]
    assert files == (2 if named == 1000 or by_run else 20)


def test_coverage_reads_texts_once(spark, tmp_path):
    write_payload(tmp_path, "york_2025-01-01_to_2025-01-01_20260101_000000.json", payload(TIMES, AIR_MEASURES))
    report = ingestion_coverage(spark, PayloadFolder(str(tmp_path), AIR_MEASURES), cities(spark, "York"))
    assert report._jdf.queryExecution().optimizedPlan().toString().count("Relation [value") == 1


def test_coverage_counts_the_newest_run_only(spark, tmp_path):
    run = "2025-01-01_to_2025-01-01"
    old = write_payload(tmp_path, f"york_{run}_20260101_000000.json", payload(hours(datetime(2025, 1, 1), 9), AIR_MEASURES))
    os.utime(old, (1_000_000_000, 1_000_000_000))
    write_payload(tmp_path, f"york_{run}_20260102_000000.json", payload(TIMES, AIR_MEASURES))
    write_payload(tmp_path, f"leeds_{run}_20260102_000000.json", {"reason": "no data"})
    report = ingestion_coverage(spark, PayloadFolder(str(tmp_path), AIR_MEASURES), cities(spark, "York", "Leeds", "Hull"))
    assert sorted(rows(report)) == [("Hull", False, 0, False), ("Leeds", True, 0, True), ("York", True, 3, True)]
    assert rows(coverage_totals(report)) == [(3, 2, 1, 3)]


def test_coverage_goes_on_after_a_broken_payload(spark, tmp_path):
    run = "2025-01-01_to_2025-01-01"
    write_payload(tmp_path, f"york_{run}_20260101_000000.json", payload(TIMES, AIR_MEASURES))
    broken = write_payload(tmp_path, f"leeds_{run}_20260101_000000.json", payload(TIMES, AIR_MEASURES))
    broken.write_text(broken.read_text()[:-40])
    report = ingestion_coverage(spark, PayloadFolder(str(tmp_path), AIR_MEASURES), cities(spark, "York", "Leeds"))
    assert sorted(rows(report)) == [("Leeds", True, 0, False), ("York", True, 3, True)]


def test_fractional_codes_are_an_error(spark):
    document = payload(TIMES, WEATHER_MEASURES)
    document["hourly"]["weather_code"] = [1, 2.5, 3.0]
    parsed = parse_payloads(texts(spark, document), WEATHER_MEASURES)
    with pytest.raises(Exception, match="fractional weather_code"):
        source_rows(parsed, WEATHER_MEASURES).collect()


def test_many_small_files(spark, tmp_path):
    document = payload(TIMES, AIR_MEASURES)
    for i in range(300):
        for stamp in ("20260101_000000", "20260102_000000"):
            (tmp_path / f"c{i}_2025-01-01_to_2025-01-01_{stamp}.json").write_text('{"hourly": {"time": ["2025-01-01T00:00"]}}' if stamp[7] == "1" else "{}")
    (tmp_path / "c0_2025-01-01_to_2025-01-01_20260103_000000.json").write_text(__import__("json").dumps(document))
    names = [f"C{i}" for i in range(300)]
    report = ingestion_coverage(spark, PayloadFolder(str(tmp_path), AIR_MEASURES), cities(spark, *names))
    assert report.count() == 300 and report.where("landed").count() == 300
    assert report.where("city = 'C0'").first().records == 3


def test_landed_files_are_written_by_tasks_under_their_names(spark, tmp_path):
    from checks.bindings import land

    docs = spark.createDataFrame([("a", '{"a": "é"}'), ("b 50%", "{}"), ("a", "second")], "name string, raw string").repartition(3)
    folder = tmp_path / "some folder"
    land(docs, str(folder), F.concat("name", F.lit("_20250103_000000.json")))
    # Nothing else is left behind, and names are not spelled as folders of partitions are.
    assert sorted(os.listdir(folder)) == ["a_20250103_000000.json", "b 50%_20250103_000000.json"]
    assert (folder / "b 50%_20250103_000000.json").read_bytes() == b"{}\n"
    both = (folder / "a_20250103_000000.json").read_text(encoding="utf-8").splitlines()
    assert sorted(both) == ["second", '{"a": "é"}']

    land(docs.limit(0), str(tmp_path / "none"), F.col("name"))
    assert os.listdir(tmp_path / "none") == []
