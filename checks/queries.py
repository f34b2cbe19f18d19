"""One query per operator, on whole test tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from checks.bindings import (
    documents,
    land,
    observations,
    payloads,
    raw_observations,
    table,
    yearly_observations,
)
from skylog.functions import parse_timestamp, slug, wall_clock, with_calendar, without_nan
from skylog.operators import joins, quality, rankings, rows, summaries
from skylog.plans import views
from skylog.plans.export import export
from skylog.plans.load import load, verify_table
from skylog.plans.transform import ingestion_coverage as ingestion_coverage_job
from skylog.plans.transform import merge_sources, observations_from_payloads, transform
from skylog.plans.validate import validate
from skylog.schemas import AIR_MEASURES, FACT_COLUMNS, FACT_PARTITIONS, LOCATIONS, MEASURES, WEATHER_MEASURES
from skylog.session import materialise, scratch_path, small_frame
from skylog.sinks import append_new, rebuild_fact, write_csv
from skylog.sources import (
    PayloadFolder,
    csv_unreadable,
    explode_payloads,
    locations,
    parse_payloads,
    payload_problems,
    read_csv_lenient,
    read_csv_strict,
    read_fact,
    read_payloads,
    row_count,
    table_exists,
    with_location,
)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

CITIES = ("click", "error", "purchase", "signup", "view")


def query(name: str) -> Callable[[Query], Query]:
    def register(build: Query) -> Query:
        QUERIES[name] = lambda spark, sf_dir: _comparable(build(spark, sf_dir))
        return build

    return register


def _comparable(df: DataFrame) -> DataFrame:
    """Dates and times as text, which every engine and driver prints alike."""
    stamps = [
        f.name for f in df.schema.fields if isinstance(f.dataType, (T.DateType, T.TimestampType, T.TimestampNTZType))
    ]
    return df.withColumns({c: F.col(c).cast("string") for c in stamps}) if stamps else df


# --- views and analysis questions ----------------------------------------------

# The names on the right are the reporting interface in ``views``.
for _key, _view in {
    "city_summary": "vw_city_air_quality_summary",
    "daily_summary": "vw_daily_air_quality",
    "hourly_pattern_by_group": "vw_hourly_patterns",
    "category_distribution": "vw_aqi_categories",
}.items():
    query(_key)(lambda spark, sf, _view=_view: views.VIEWS[_view](observations(spark, sf)))

for _key, _question in {
    "city_overview": "city_overview",
    "worst_hours_topk": "worst_hours",
    "category_hours_pivot": "category_hours",
    "threshold_exceedance": "threshold_exceedance",
    "city_rank": "city_rank",
    "hour_of_day": "hour_of_day",
    "hour_by_city": "hour_by_city",
    "weekday_pattern": "weekday_pattern",
    "wind_bands": "wind_bands",
    "dry_wet": "dry_wet",
    "temperature_bands": "temperature_bands",
    "worst_day_per_group": "worst_day",
}.items():
    query(_key)(lambda spark, sf, _question=_question: views.QUESTIONS[_question](observations(spark, sf)))


@query("monthly_summary")
def monthly_summary(spark, sf):
    return summaries.monthly_summary(yearly_observations(spark, sf))


@query("monthly_trend")
def monthly_trend(spark, sf):
    return summaries.trend(yearly_observations(spark, sf), ("city", "month"))


@query("monthly_trend_default")
def monthly_trend_default(spark, sf):
    return views.QUESTIONS["monthly_trend"](yearly_observations(spark, sf))


@query("worst_months_default")
def worst_months_default(spark, sf):
    return views.QUESTIONS["worst_months"](yearly_observations(spark, sf))


@query("worst_months_topk")
def worst_months_topk(spark, sf):
    return rankings.worst_periods(yearly_observations(spark, sf), ("city", "year", "month"))


@query("period_over_period")
def period_over_period(spark, sf):
    return rankings.period_change(yearly_observations(spark, sf))


@query("day_over_day")
def day_over_day(spark, sf):
    return rankings.period_change(observations(spark, sf), period=("date",), name="day")


@query("registered_views")
def registered_views(spark, sf):
    """The reporting views asked in SQL."""
    views.register_views(observations(spark, sf))
    return spark.sql(
        """
        SELECT c.city, c.hours AS hazardous_hours, s.hourly_observations, s.avg_aqi
        FROM vw_aqi_categories c JOIN vw_city_air_quality_summary s ON c.city = s.city
        WHERE c.aqi_category = 'Hazardous'
        """
    )


# --- payloads ------------------------------------------------------------------


@query("payload_explode")
def payload_explode(spark, sf):
    packed = payloads(raw_observations(spark, sf), WEATHER_MEASURES)
    hours = explode_payloads(parse_payloads(packed, WEATHER_MEASURES), WEATHER_MEASURES)
    return hours.withColumn("timestamp", parse_timestamp(F.col("timestamp")))


@query("payload_array_length_check")
def payload_array_length_check(spark, sf):
    """Documents of one city lose the last wind speed."""
    wind = F.col("entries.wind_speed_10m")
    short = F.when(F.col("city") == "view", F.slice(wind, 1, F.size(wind) - 1)).otherwise(wind)
    packed = payloads(raw_observations(spark, sf), WEATHER_MEASURES, short, "wind_speed_10m")
    return payload_problems(parse_payloads(packed, WEATHER_MEASURES), WEATHER_MEASURES, ("city", "chunk"))


@query("payload_required_keys")
def payload_required_keys(spark, sf):
    """Documents of one city lose a measure."""
    gone = F.when(F.col("city") != "click", F.col("entries.ozone"))
    packed = payloads(raw_observations(spark, sf), AIR_MEASURES, gone, "ozone")
    return payload_problems(parse_payloads(packed, AIR_MEASURES), AIR_MEASURES, ("city", "chunk"))


# --- rows ----------------------------------------------------------------------


@query("parse_timestamp_lenient")
def parse_timestamp_lenient(spark, sf):
    events = table(spark, sf, "events")
    text, kind = events.ts.cast("string"), events.event_type
    spoilt = (
        F.when(kind == "error", F.lit("not a time"))
        .when(kind == "signup", F.lit(None).cast("string"))
        .when(kind == "view", F.replace(text, F.lit(" "), F.lit("T")))
        .otherwise(text)
    )
    parsed = events.select("event_id", parse_timestamp(spoilt).alias("timestamp"))
    return parsed.na.drop(subset=["timestamp"])


@query("calendar_features")
def calendar_features(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", F.col("o_orderdate").alias("timestamp"))
    return with_calendar(orders).drop("timestamp")


@query("city_slug")
def city_slug(spark, sf):
    return table(spark, sf, "part").select("p_partkey", slug(F.col("p_name")).alias("slug"))


@query("clean_observations")
def clean_observations(spark, sf):
    """Every row twice and some without a time."""
    obs = raw_observations(spark, sf)
    timed = obs.withColumn("timestamp", F.when(obs.k >= 10, obs.timestamp)).drop("event_id", "k")
    return rows.clean_observations(rows.concat_sources([timed, timed]))


@query("concat_sources")
def concat_sources(spark, sf):
    customers = table(spark, sf, "customer").selectExpr("c_name AS name", "c_nationkey AS nation", "c_acctbal AS balance")
    suppliers = table(spark, sf, "supplier").selectExpr("s_acctbal AS balance", "s_name AS name", "s_nationkey AS nation")
    return rows.concat_sources([customers, suppliers])


@query("drop_exact_duplicates")
def drop_exact_duplicates(spark, sf):
    lines = table(spark, sf, "lineitem").select("l_returnflag", "l_linestatus", "l_linenumber", "l_tax")
    return rows.drop_exact_duplicates(lines)


@query("latest_per_key")
def latest_per_key(spark, sf):
    events = table(spark, sf, "events").select("event_type", "user_id", "ts", "event_id", "value")
    return rows.first_per_key(events, ["event_type", "user_id"], [F.desc("ts"), F.desc("event_id")])


@query("nan_to_null")
def nan_to_null(spark, sf):
    obs = raw_observations(spark, sf)
    holes = obs.withColumns(
        {
            "us_aqi": F.when(obs.k < 10, F.lit(float("nan"))).otherwise(obs.us_aqi),
            "pm2_5": F.when(obs.k >= 90, F.lit(float("nan"))).otherwise(obs.pm2_5),
        }
    )
    return without_nan(holes.select("event_id", "us_aqi", "pm2_5", "ozone"))


# --- joins and sets ------------------------------------------------------------


@query("attach_location")
def attach_location(spark, sf):
    customers = table(spark, sf, "customer").select("c_custkey", "c_name", F.col("c_nationkey").alias("n_nationkey"))
    return with_location(customers, table(spark, sf, "nation"), "n_nationkey")


@query("ingestion_coverage")
def ingestion_coverage(spark, sf):
    """Orders as members, their lines as records."""
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderpriority")
    lines = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), F.lit(1).alias("lines"))
    return joins.coverage(orders, lines, ["o_orderkey"], "lines")


@query("ingestion_totals")
def ingestion_totals(spark, sf):
    return joins.coverage_totals(ingestion_coverage(spark, sf))


@query("merged_observations")
def merged_observations(spark, sf):
    """The two halves of the measures put together again, with the calendar."""
    obs = raw_observations(spark, sf)
    weather = obs.select("city", "timestamp", *WEATHER_MEASURES)
    air = obs.select("city", "timestamp", *AIR_MEASURES)
    return rows.clean_observations(merge_sources(weather, air), unique=True, ordered=False).select(*FACT_COLUMNS)


@query("merge_one_to_one")
def merge_one_to_one(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_totalprice", "o_orderpriority")
    lines = (
        table(spark, sf, "lineitem")
        .groupBy(F.col("l_orderkey").alias("o_orderkey"))
        .agg(F.count(F.lit(1)).alias("lines"), F.max("l_quantity").alias("max_quantity"))
    )
    return joins.merge_one_to_one(orders, lines, ["o_orderkey"])


def _order_keys(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    lines = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"))
    return orders, lines


@query("missing_members")
def missing_members(spark, sf):
    orders, lines = _order_keys(spark, sf)
    return joins.missing_members(orders, lines, ["o_orderkey"])


@query("unexpected_members")
def unexpected_members(spark, sf):
    orders, lines = _order_keys(spark, sf)
    return joins.unexpected_members(orders.where("o_orderstatus <> 'P'"), lines, ["o_orderkey"])


# --- quality -------------------------------------------------------------------


@query("duplicate_key_stats")
def duplicate_key_stats(spark, sf):
    return quality.duplicate_stats(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


def _with_holes(spark, sf):
    obs = raw_observations(spark, sf)
    k = obs.k
    return obs.withColumns(
        {
            "us_aqi": F.when(k >= 10, obs.us_aqi),
            "ozone": F.when(k != 50, obs.ozone),
            "timestamp": F.when(k != 60, obs.timestamp),
        }
    ).drop("event_id", "k")


@query("null_profile")
def null_profile(spark, sf):
    return quality.null_profile(_with_holes(spark, sf))


@query("dataset_profile")
def dataset_profile(spark, sf):
    return quality.dataset_profile(with_calendar(_with_holes(spark, sf)))


@query("rows_by_city")
def rows_by_city(spark, sf):
    obs = raw_observations(spark, sf)
    return quality.rows_by_city(obs.withColumn("city", F.when(obs.k >= 10, obs.city)))


def _spoilt(spark, sf):
    """Observations with values out of range and some keys repeated."""
    obs = raw_observations(spark, sf)
    spoilt = obs.withColumns(
        {
            "relative_humidity_2m": obs.relative_humidity_2m * 1.25 - 5.0,
            "pm10": obs.pm10 - 40.0,
            "ozone": obs.ozone - 3.0,
            "timestamp": F.when(obs.k != 60, obs.timestamp),
        }
    )
    return with_calendar(spoilt).withColumn("hour", F.col("hour") + 1).select(*FACT_COLUMNS)


_EXPECTED = quality.Expectations(
    cities=("click", "error", "purchase", "refund", "signup"),
    start=datetime(2024, 1, 1),
    end=datetime(2024, 1, 30, 23),
)


@query("quality_report")
def quality_report(spark, sf):
    return quality.quality_report(_spoilt(spark, sf), _EXPECTED)


@query("quality_verdict")
def quality_verdict(spark, sf):
    return quality.verdict(quality.quality_report(_spoilt(spark, sf), _EXPECTED))


@query("range_violations")
def range_violations(spark, sf):
    customers = table(spark, sf, "customer").select("c_custkey", "c_acctbal")
    return customers.where(quality.out_of_range("c_acctbal", 0))


@query("constraint_quarantine")
def constraint_quarantine(spark, sf):
    _, broken = quality.split_by_rules(_spoilt(spark, sf))
    return broken.select("city", "timestamp", "us_aqi", F.concat_ws("; ", "broken_rules").alias("broken_rules"))


# --- tables --------------------------------------------------------------------


def _appended(spark, sf):
    """A table with the first half of the month at a higher level, then a batch with everything twice."""
    obs = observations(spark, sf)
    path = scratch_path(spark, "fact")
    early = obs.where(F.col("timestamp") < wall_clock(datetime(2024, 1, 16)))
    rebuild_fact(early.withColumn("us_aqi", early.us_aqi + 1000.0), path)
    batch = rows.concat_sources([obs.withColumn("us_aqi", obs.us_aqi + 500.0), obs])
    return append_new(batch, path, [F.asc(m) for m in MEASURES]), path


@query("idempotent_append")
def idempotent_append(spark, sf):
    _, path = _appended(spark, sf)
    return read_fact(spark, path)


@query("append_counts")
def append_counts(spark, sf):
    counts, _ = _appended(spark, sf)
    return counts


@query("post_load_verify")
def post_load_verify(spark, sf):
    _, path = _appended(spark, sf)
    return verify_table(spark, path, observations(spark, sf).select("city", "timestamp").distinct().count(), len(CITIES))


@query("csv_roundtrip")
def csv_roundtrip(spark, sf):
    path = scratch_path(spark, "csv")
    write_csv(observations(spark, sf), path)
    return read_csv_strict(spark, path)


@query("csv_roundtrip_lenient")
def csv_roundtrip_lenient(spark, sf):
    path = scratch_path(spark, "csv")
    write_csv(_with_holes(spark, sf), path)
    return read_csv_lenient(spark, path)


@query("export_manifest")
def export_manifest(spark, sf):
    result = export(observations(spark, sf), scratch_path(spark, "export"))
    return result.manifest.select("source", "file", "rows", "columns")


@query("export_summary")
def export_summary(spark, sf):
    return export(observations(spark, sf), scratch_path(spark, "export")).summary


@query("payloads_to_summary")
def payloads_to_summary(spark, sf):
    """Payload text of two sources to a gated, loaded table, and its summary."""
    raw = raw_observations(spark, sf)
    weather = parse_payloads(payloads(raw, WEATHER_MEASURES), WEATHER_MEASURES)
    air = parse_payloads(payloads(raw, AIR_MEASURES), AIR_MEASURES)
    batch = materialise(observations_from_payloads(weather, air), "batch")
    path = scratch_path(spark, "fact")
    load(batch, path, quality.Expectations(cities=CITIES, start=None, end=None))
    return summaries.group_summary(read_fact(spark, path))


# --- files -----------------------------------------------------------------------


def _text_columns(df: DataFrame, **changed) -> DataFrame:
    """All columns as a CSV would print them, some of them changed."""
    return df.select(*[(changed[c] if c in changed else F.col(c).cast("string")).alias(c) for c in df.columns])


def _csv_with(spark, df: DataFrame) -> str:
    path = scratch_path(spark, "csv")
    write_csv(df, path)
    return path


@query("csv_unreadable_values")
def csv_unreadable_values(spark, sf):
    """Values of a CSV that cannot be read, per column: words, and codes with a fraction."""
    obs = observations(spark, sf)
    text = _text_columns(
        obs,
        us_aqi=F.when(obs.weather_code % 10 == 3, F.lit("abc")).otherwise(obs.us_aqi.cast("string")),
        ozone=F.when(obs.weather_code == 50, F.lit("n/a")).when(obs.weather_code == 51, F.lit("nan")).otherwise(obs.ozone.cast("string")),
        weather_code=F.when(obs.weather_code % 4 == 1, F.concat(obs.weather_code.cast("string"), F.lit(".5"))).otherwise(obs.weather_code.cast("string")),
    )
    return csv_unreadable(spark, _csv_with(spark, text))


@query("csv_decimal_codes")
def csv_decimal_codes(spark, sf):
    """Integers printed as ``3.0`` come back as integers."""
    obs = observations(spark, sf)
    decimal = {c: F.concat(F.col(c).cast("string"), F.lit(".0")) for c in ("weather_code", "year", "hour")}
    return read_csv_strict(spark, _csv_with(spark, _text_columns(obs, **decimal)))


@query("load_with_quarantine")
def load_with_quarantine(spark, sf):
    """A gated load that sets rows aside, twice: what is kept, what is set aside, and what the second load adds."""
    batch = materialise(observations(spark, sf).withColumn("pm10", F.col("pm10") - 40.0), "batch")
    path, aside = scratch_path(spark, "fact"), scratch_path(spark, "aside")
    expected = quality.Expectations(cities=CITIES, start=None, end=None)
    load(batch, path, expected, quarantine=aside)
    kept, first = read_fact(spark, path).count(), spark.read.parquet(aside).count()
    again = load(batch, path, expected, quarantine=aside).counts.first().inserted
    return small_frame(
        spark, [(kept, first, again, spark.read.parquet(aside).count())], "kept bigint, set_aside bigint, reloaded bigint, quarantined bigint"
    )


@query("load_verify_detects")
def load_verify_detects(spark, sf):
    """Rows that get into the table beside a load make its verification fail."""
    obs = observations(spark, sf)
    path = scratch_path(spark, "fact")
    load(materialise(obs, "batch"), path, quality.Expectations(cities=CITIES, start=None, end=None))
    obs.where("weather_code < 10").write.mode("append").partitionBy(*FACT_PARTITIONS).parquet(path)
    return verify_table(spark, path, obs.count(), len(CITIES))


def _landed(spark, sf, measures: tuple[str, ...]) -> tuple[PayloadFolder, DataFrame]:
    """A folder with an older and a newer historical run and a recent one of every city, and the cities."""
    raw = raw_observations(spark, sf)
    folder = scratch_path(spark, "landed")
    level = measures[-1]
    runs = [
        (1000.0, "_2024-01-01_to_2024-01-31_20250101_000000.json"),
        (0.0, "_2024-01-01_to_2024-01-31_20250102_000000.json"),
        (500.0, "_20250103_000000.json"),
    ]
    for added, ending in runs:
        docs = documents(raw.withColumn(level, F.col(level) + F.lit(added).cast(raw.schema[level].dataType)), measures)
        land(docs, folder, F.concat("slug", F.lit(ending)))
    return PayloadFolder(folder, measures), documents(raw, measures).select("city", "slug")


def _levels(payloads_: DataFrame) -> DataFrame:
    level = F.col("hourly.us_aqi")
    return payloads_.select("city", F.size("hourly.time").cast("bigint").alias("hours"), F.array_min(level).alias("lowest"), F.array_max(level).alias("highest"))


@query("payload_files_latest")
def payload_files_latest(spark, sf):
    folder, cities = _landed(spark, sf, AIR_MEASURES)
    return _levels(read_payloads(spark, folder, cities))


@query("payload_files_recent")
def payload_files_recent(spark, sf):
    folder, cities = _landed(spark, sf, AIR_MEASURES)
    return _levels(read_payloads(spark, PayloadFolder(folder.path, AIR_MEASURES, recent=True), cities))


@query("transform_files")
def transform_files(spark, sf):
    """Payload files of both sources to the processed table."""
    weather, cities = _landed(spark, sf, WEATHER_MEASURES)
    air, _ = _landed(spark, sf, AIR_MEASURES)
    path = scratch_path(spark, "processed")
    transform(spark, weather.path, air.path, path, cities)
    return read_fact(spark, path).withColumn("city", F.element_at(F.split("city", " "), 1))


@query("coverage_files")
def coverage_files(spark, sf):
    """Coverage of a folder in which some documents are cut short and one city has none."""
    raw = raw_observations(spark, sf)
    folder = scratch_path(spark, "landed")
    docs = documents(raw, AIR_MEASURES)
    number = F.element_at(F.split("city", " "), 2).cast("int")
    cut = F.when(number % 3 == 1, F.substring("raw", 1, 100)).otherwise(F.col("raw"))
    land(docs.withColumn("raw", cut), folder, F.concat("slug", F.lit("_2024-01-01_to_2024-01-31_20250101_000000.json")))
    absent = small_frame(spark, [("nowhere 0", "nowhere_0")], "city string, slug string")
    return ingestion_coverage_job(spark, PayloadFolder(folder, AIR_MEASURES), docs.select("city", "slug").unionByName(absent))


@query("validation_details")
def validation_details(spark, sf):
    """All detail frames of the validation job in one, and the number of checks that failed."""
    result = validate(_spoilt(spark, sf), _EXPECTED)
    frames = [
        result.missing_cities.select(F.lit("missing city").alias("kind"), F.col("city").alias("name"), F.lit(1).cast("bigint").alias("value")),
        result.unexpected_cities.select(F.lit("unexpected city"), "city", F.lit(1).cast("bigint")),
        result.missing_values.select(F.lit("missing value"), "column", "missing"),
        result.rows_by_city.select(F.lit("rows"), "city", "rows"),
        small_frame(spark, [("failed checks", "all", result.failed_checks)], "kind string, name string, value bigint"),
    ]
    return reduce(DataFrame.union, frames)


@query("table_probe")
def table_probe(spark, sf):
    """Whether a table is there, before and after it is written, and its rows."""
    path = scratch_path(spark, "fact")
    before = table_exists(spark, path)
    rebuild_fact(observations(spark, sf), path)
    counted = row_count(read_fact(spark, path))
    return small_frame(spark, [(before, table_exists(spark, path), counted)], "before boolean, after boolean, rows bigint")


@query("configured_locations")
def configured_locations(spark, sf):
    """The configured locations, each with the nations that fall to it by number."""
    place = F.row_number().over(Window.orderBy("city")) - 1
    places = locations(spark).withColumn("place", place)
    nations = table(spark, sf, "nation").groupBy((F.col("n_nationkey") % len(LOCATIONS)).alias("place")).agg(F.count(F.lit(1)).alias("nations"))
    return places.join(nations, "place", "left").select("city", "latitude", "longitude", "slug", F.coalesce("nations", F.lit(0).cast("bigint")).alias("nations"))
