from __future__ import annotations

from datetime import timedelta
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from conftest import rows, ts
from skylog.functions import with_calendar
from skylog.operators.quality import Expectations
from skylog.plans.export import export
from skylog.plans.load import LoadError, load, verify_table
from skylog.plans.validate import QualityError, validate
from skylog.schemas import FACT_COLUMNS, MEASURES, OBSERVATION
from skylog.sinks import ExportError, append_keyed, append_new, export_tables, new_rows, rebuild_fact, write_csv
from skylog.sinks.fact import read_partitions, in_partitions, touched_partitions
from skylog.sources import csv_unreadable, read_csv_lenient, read_csv_strict, read_fact, row_count, table_exists

ORDER = ["us_aqi"]
START = ts("2025-01-01T00:00")


def obs(spark, *rows_):
    """Rows as (city, hours since the start, level)."""
    data = [(c, START + timedelta(hours=h), *[1.0] * (len(MEASURES) - 1), v) for c, h, v in rows_]
    names = ", ".join(f"{m} double" for m in MEASURES)
    df = spark.createDataFrame(data, f"city string, timestamp timestamp_ntz, {names}")
    df = df.withColumn("weather_code", F.col("weather_code").cast("int"))
    return with_calendar(df).select(*FACT_COLUMNS)


def content(spark, path):
    return {(r.city, r.timestamp): r.us_aqi for r in read_fact(spark, path).collect()}


def hour(h):
    return START + timedelta(hours=h)


def test_append_keeps_existing_rows_and_the_first_new_copy(spark, tmp_path):
    path = str(tmp_path / "fact")
    first = append_new(obs(spark, ("a", 0, 1.0), ("a", 1, 2.0)), path, ORDER)
    assert rows(first) == [(0, 2, 2)]
    batch = obs(spark, ("a", 1, 99.0), ("a", 2, 7.0), ("a", 2, 6.0), ("b", 0, 5.0))
    assert rows(append_new(batch, path, ORDER)) == [(2, 2, 4)]
    assert content(spark, path) == {("a", hour(0)): 1.0, ("a", hour(1)): 2.0, ("a", hour(2)): 6.0, ("b", hour(0)): 5.0}
    assert rows(append_new(batch, path, ORDER)) == [(4, 0, 4)]
    assert read_fact(spark, path).columns == list(FACT_COLUMNS)


def test_append_reads_only_the_months_of_the_batch(spark, tmp_path):
    path = str(tmp_path / "fact")
    rebuild_fact(obs(spark, ("a", 0, 1.0), ("a", 24 * 40, 2.0)), path)
    assert rows(append_new(obs(spark, ("a", 24 * 40, 9.0), ("a", 24 * 41, 3.0)), path, ORDER)) == [(2, 1, 3)]
    february = read_fact(spark, path).where("year = 2025 AND month = 2")
    plan = february._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year" in plan and february.count() == 2


def test_append_opens_no_file_of_other_months(spark, tmp_path):
    path = str(tmp_path / "fact")
    rebuild_fact(obs(spark, ("a", 0, 1.0), ("a", 24 * 40, 2.0)), path)
    for file in Path(path).glob("year=2025/month=1/*.parquet"):
        file.write_bytes(b"not parquet")
    done = append_keyed(obs(spark, ("a", 24 * 40, 9.0), ("a", 24 * 41, 3.0)), path, ORDER)
    assert done.inserted == 1 and [(r.year, r.month) for r in done.touched] == [(2025, 2)]
    assert load(obs(spark, ("a", 24 * 41, 3.0), ("b", 24 * 41, 3.0)), path, EXPECTED).inserted == 1
    assert read_partitions(spark, path, done.touched).count() == 3
    assert append_keyed(obs(spark).limit(0), str(tmp_path / "new"), ORDER).inserted == 0


def test_a_large_month_is_written_by_several_tasks(spark, tmp_path):
    path = str(tmp_path / "fact")
    data = obs(spark, *[(f"c{i}", h, float(i)) for i in range(40) for h in range(240)])
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "20k")
    try:
        rebuild_fact(data, path)
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    files = list(Path(path).glob("year=2025/month=1/part-*"))
    assert len(files) > 1 and read_fact(spark, path).count() == 9600


def test_a_batch_of_another_type_is_refused(spark, tmp_path):
    path = str(tmp_path / "fact")
    drifted = obs(spark, ("a", 0, 1.0)).withColumn("weather_code", F.lit(1.0))
    with pytest.raises(TypeError, match="weather_code is double, not int"):
        load(drifted, path, None)
    rebuild_fact(obs(spark, ("a", 0, 1.0)), path)
    with pytest.raises(TypeError, match="weather_code is double, not int"):
        append_new(drifted, path, ORDER)
    assert content(spark, path) == {("a", hour(0)): 1.0}


def test_a_key_cannot_get_in_twice_under_another_month(spark, tmp_path):
    path = str(tmp_path / "fact")
    batch = obs(spark, ("a", 0, 1.0), ("a", 1, 1.0))
    append_new(batch, path, ORDER)
    moved = batch.withColumn("month", F.lit(2))
    with pytest.raises(ValueError, match="do not fit their timestamp: 2"):
        append_new(moved, path, ORDER)
    with pytest.raises(QualityError, match="break constraints: 2"):
        load(moved, path, None)
    assert read_fact(spark, path).count() == 2


def test_known_keys_go_before_the_sort(spark, tmp_path):
    table = obs(spark, ("a", 0, 1.0))
    plan = new_rows(table, table, ORDER)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Window") < plan.index("LeftAnti")


def test_the_load_check_reads_the_months_of_the_batch(spark, tmp_path):
    path = str(tmp_path / "fact")
    rebuild_fact(obs(spark, ("a", 0, 1.0), ("a", 24 * 40, 2.0)), path)
    batch = obs(spark, ("a", 24 * 41, 2.0))
    months = in_partitions(read_fact(spark, path), touched_partitions(batch))
    assert len(months.inputFiles()) >= 1 and months.count() == 1
    plan = months._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year" in plan


def test_rebuild_replaces(spark, tmp_path):
    path = str(tmp_path / "fact")
    rebuild_fact(obs(spark, ("a", 0, 1.0)), path)
    rebuild_fact(obs(spark, ("b", 0, 2.0)), path)
    assert content(spark, path) == {("b", hour(0)): 2.0}


def test_probes(spark, tmp_path):
    path = str(tmp_path / "fact")
    assert not table_exists(spark, path) and not table_exists(spark, "no_such_table")
    with pytest.raises(FileNotFoundError, match="no observation table"):
        read_fact(spark, path)
    rebuild_fact(obs(spark, ("a", 0, 1.0), ("a", 1, 1.0)), path)
    assert table_exists(spark, path) and row_count(read_fact(spark, path)) == 2


EXPECTED = Expectations(cities=("a", "b"), start=None, end=None)


def test_load_gates_and_verifies(spark, tmp_path):
    path = str(tmp_path / "fact")
    result = load(obs(spark, ("a", 0, 1.0), ("b", 0, 2.0)), path, EXPECTED)
    assert rows(result.counts) == [(0, 2, 2)] and result.check.passed
    more = load(obs(spark, ("a", 1, 1.0), ("b", 0, 3.0)), path, EXPECTED)
    assert rows(more.counts) == [(2, 1, 3)] and more.check.rows == 3


def test_load_refuses_bad_data_and_writes_nothing(spark, tmp_path):
    path = str(tmp_path / "fact")
    with pytest.raises(QualityError, match="non_negative_us_aqi"):
        load(obs(spark, ("a", 0, -1.0), ("b", 0, 2.0)), path, EXPECTED)
    odd = obs(spark, ("a", 0, 1.0), ("b", 0, 2.0)).withColumn("hour", F.lit(24))
    with pytest.raises(QualityError, match=r"row_constraints \(2\)"):
        load(odd, path, EXPECTED)
    assert not table_exists(spark, path)


def test_load_can_put_bad_rows_aside(spark, tmp_path):
    path, aside = str(tmp_path / "fact"), str(tmp_path / "aside")
    batch = obs(spark, ("a", 0, 1.0), ("b", 0, 2.0), ("b", 1, -2.0))
    with pytest.raises(QualityError, match="break constraints: 1"):
        load(batch, path, None)
    result = load(batch, path, None, quarantine=aside)
    assert rows(result.counts) == [(0, 2, 2)]
    assert [r.broken_rules for r in spark.read.parquet(aside).collect()] == [["us_aqi negative"]]


def test_quarantine_works_under_the_gate_and_adds_no_copies(spark, tmp_path):
    path, aside = str(tmp_path / "fact"), str(tmp_path / "aside")
    batch = obs(spark, ("a", 0, 1.0), ("b", 0, 2.0), ("b", 1, -2.0))
    for inserted in (2, 0):
        assert load(batch, path, EXPECTED, quarantine=aside).counts.first().inserted == inserted
        assert spark.read.parquet(aside).count() == 1


def test_quarantine_has_a_folder_per_batch(spark, tmp_path):
    path, aside = str(tmp_path / "fact"), str(tmp_path / "aside")
    good = [("a", 0, 1.0), ("b", 0, 2.0)]
    for bad in ([("b", 1, -2.0), ("b", 1, -2.0)], [("b", 2, -3.0)], [("b", 1, -2.0)]):
        load(obs(spark, *good, *bad), path, EXPECTED, quarantine=aside)
    assert len(list(Path(aside).glob("batch=*"))) == 2
    assert sorted(r.us_aqi for r in spark.read.parquet(aside).collect()) == [-3.0, -2.0]


def test_a_refused_load_leaves_no_quarantine(spark, tmp_path):
    path, aside = str(tmp_path / "fact"), str(tmp_path / "aside")
    with pytest.raises(QualityError, match="missing_cities"):
        load(obs(spark, ("a", 0, 1.0), ("a", 1, -2.0)), path, EXPECTED, quarantine=aside)
    assert not Path(aside).exists() and not table_exists(spark, path)


def test_a_table_that_repeats_keys_is_noticed(spark, tmp_path):
    path = str(tmp_path / "fact")
    twice = obs(spark, ("a", 0, 1.0), ("a", 0, 2.0), ("b", 0, 2.0))
    rebuild_fact(twice, path)
    with pytest.raises(LoadError, match="repeats keys"):
        load(obs(spark, ("a", 1, 1.0), ("b", 1, 2.0)), path, EXPECTED)
    assert read_fact(spark, path).count() == 3


def test_verification_fails_on_extra_rows(spark, tmp_path):
    path = str(tmp_path / "fact")
    batch = obs(spark, ("a", 0, 1.0), ("b", 0, 2.0))
    load(batch, path, EXPECTED)
    assert verify_table(spark, path, 2, 2).first().passed
    batch.withColumn("us_aqi", F.lit(9.0)).write.mode("append").partitionBy("year", "month").parquet(path)
    spoilt = verify_table(spark, path, 2, 2).first()
    assert (spoilt.passed, spoilt.rows, spoilt.duplicate_groups) == (False, 4, 2)


def test_load_leaves_no_scratch(spark, tmp_path):
    shared = Path(spark.conf.get("spark.checkpoint.dir").removeprefix("file:"))
    before = set(shared.glob("*"))
    load(obs(spark, ("a", 0, 1.0), ("b", 0, 2.0)), str(tmp_path / "fact"), EXPECTED)
    assert set(shared.glob("*")) == before


def test_csv_round_trip_and_format(spark, tmp_path):
    path = str(tmp_path / "csv")
    df = obs(spark, (' odd, "city" ', 0, 1.0), ("a", 1, 2.0)).withColumn("ozone", F.lit(None).cast("double"))
    fraction = df.withColumn("timestamp", df.timestamp + F.expr("INTERVAL '0.000125' SECOND"))
    assert write_csv(df.unionByName(fraction), path) == 4
    text = "".join(p.read_text() for p in Path(path).glob("part-*"))
    assert "a,2025-01-01 01:00:00,1.0" in text and "a,2025-01-01 01:00:00.000125,1.0" in text
    back = read_csv_strict(spark, path)
    assert back.schema == OBSERVATION
    assert sorted(rows(back), key=str) == sorted(rows(df.unionByName(fraction)), key=str)


def _csv_row(**values):
    row = dict.fromkeys(MEASURES, "1.0") | {"weather_code": "1", "city": "a", "timestamp": "2025-01-01 00:00:00", "date": "2025-01-01"}
    row |= {"year": "2025", "month": "1", "day": "1", "hour": "0", "day_of_week": "Wednesday"} | values
    return ",".join(row[c] for c in FACT_COLUMNS) + "\n"


def test_unreadable_measures_are_counted_and_fail_the_report(spark, tmp_path):
    file = tmp_path / "x.csv"
    head = ",".join(FACT_COLUMNS) + "\n"
    file.write_text(head + _csv_row(us_aqi="abc") + _csv_row(us_aqi="", weather_code="2.5", timestamp="2025-01-01 01:00:00", hour="1") + _csv_row(us_aqi="nan", hour="x"))
    lost = {r.column: r.unreadable for r in csv_unreadable(spark, str(file)).collect() if r.unreadable}
    assert lost == {"us_aqi": 1, "weather_code": 1, "hour": 1}
    result = validate(read_csv_lenient(spark, str(file)), Expectations(cities=("a",), start=None, end=None), csv_unreadable(spark, str(file)))
    failed = {r.check for r in result.report if not r.passed}
    assert not result.passed and {"readable_us_aqi", "readable_weather_code", "readable_hour"} <= failed
    with pytest.raises(Exception, match="unreadable"):
        read_csv_strict(spark, str(file)).collect()


def test_codes_printed_as_decimals(spark, tmp_path):
    file = tmp_path / "x.csv"
    file.write_text(",".join(FACT_COLUMNS) + "\n" + _csv_row(weather_code="3.0", year="2025.0") + _csv_row(weather_code=""))
    for read in (read_csv_lenient, read_csv_strict):
        assert sorted([r.weather_code for r in read(spark, str(file)).collect()], key=str) == [3, None]
    assert all(r.unreadable == 0 for r in csv_unreadable(spark, str(file)).collect())


def test_nan_in_a_csv_is_a_missing_value(spark, tmp_path):
    df = obs(spark, ("a", 0, float("nan")), ("a", 1, 2.0))
    write_csv(df, str(tmp_path))
    for back in (read_csv_lenient(spark, str(tmp_path)), read_csv_strict(spark, str(tmp_path))):
        assert sorted([r.us_aqi for r in back.collect()], key=str) == [2.0, None]


def test_part_files_must_have_one_header(spark, tmp_path):
    write_csv(obs(spark, ("a", 0, 1.0)), str(tmp_path))
    (tmp_path / "part-99999.csv").write_text("timestamp,city\n2025-01-01 00:00:00,a\n")
    with pytest.raises(Exception):
        read_csv_strict(spark, str(tmp_path)).collect()


def test_lenient_and_strict_reading(spark, tmp_path):
    file = tmp_path / "x.csv"
    head = ",".join(reversed(FACT_COLUMNS))
    row = dict.fromkeys(MEASURES, "1.0") | {"weather_code": "1", "city": "a", "timestamp": "junk", "date": "2025-01-01"}
    row |= {"year": "2025", "month": "1", "day": "1", "hour": "0", "day_of_week": "Wednesday"}
    file.write_text(f"{head},extra\n" + ",".join(row[c] for c in reversed(FACT_COLUMNS)) + ",more\n")
    lenient = read_csv_lenient(spark, str(file)).first()
    assert (lenient.timestamp, lenient.city, lenient.extra, lenient.weather_code) == (None, "a", "more", 1)
    with pytest.raises(Exception):
        read_csv_strict(spark, str(file)).collect()
    file.write_text(f"{head}\n" + ",".join((row | {"timestamp": "2025-01-01 00:00:00"})[c] for c in reversed(FACT_COLUMNS)) + "\n")
    assert read_csv_strict(spark, str(file)).first().timestamp == START
    file.write_text("city,timestamp\na,2025-01-01 00:00:00\n")
    with pytest.raises(ValueError, match="missing required columns"):
        read_csv_strict(spark, str(file))


def test_export_manifest(spark, tmp_path):
    result = export(obs(spark, ("a", 0, 10.0), ("a", 1, 60.0), ("b", 0, 400.0)), str(tmp_path))
    got = {r.source: r for r in result.manifest.collect()}
    assert {s: (r.rows, r.columns) for s, r in got.items()} == {
        "observations": (3, 22),
        "vw_city_air_quality_summary": (2, 9),
        "vw_monthly_air_quality": (2, 9),
        "vw_daily_air_quality": (2, 11),
        "vw_hourly_patterns": (3, 8),
        "vw_aqi_categories": (3, 5),
    }
    for r in got.values():
        assert r.bytes == sum(p.stat().st_size for p in Path(r.path).glob("part-*")) > 0
        assert spark.read.option("header", True).csv(r.path).count() == r.rows
    assert rows(result.summary) == [(6, 15)]


def test_export_of_nothing_is_an_error(spark, tmp_path):
    with pytest.raises(ExportError, match="observations"):
        export(spark.createDataFrame([], OBSERVATION), str(tmp_path))
    with pytest.raises(ExportError, match="empty"):
        export_tables(
            spark,
            {"full": (spark.range(3), "full.csv"), "empty": (spark.range(0), "empty.csv")},
            str(tmp_path),
        )
