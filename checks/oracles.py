"""The same questions in SQL for DuckDB, on the same tables."""

from __future__ import annotations


def r2(value: str) -> str:
    return f"CAST(round(CAST({value} AS DECIMAL(28,12)), 2) AS DOUBLE)"


def avg(column: str, name: str) -> str:
    return f"{r2(f'avg({column})')} AS {name}"


def top(column: str, name: str) -> str:
    return f"{r2(f'max({column})')} AS {name}"


def ints(**columns: str) -> str:
    return ", ".join(f"CAST({expr} AS INTEGER) AS {name}" for name, expr in columns.items())


RAW = """raw AS (
  SELECT event_id, k, event_type AS city, ts AS "timestamp",
    k + 10.0e0 AS temperature_2m,
    CAST(k AS DOUBLE) AS relative_humidity_2m,
    CASE WHEN k % 5 = 0 THEN k / 10.0e0 ELSE 0.0e0 END AS precipitation,
    k / 4.0e0 AS wind_speed_10m,
    k + 950.0e0 AS surface_pressure,
    100.0e0 - k AS cloud_cover,
    k AS weather_code,
    CAST(k AS DOUBLE) AS pm2_5,
    CAST(k + user_id AS DOUBLE) AS pm10,
    user_id * 2.0e0 AS carbon_monoxide,
    k / 2.0e0 AS nitrogen_dioxide,
    k / 8.0e0 AS sulphur_dioxide,
    CAST(user_id AS DOUBLE) AS ozone,
    value AS us_aqi
  FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events)
)"""

WEATHER = (
    "temperature_2m, relative_humidity_2m, precipitation, wind_speed_10m, "
    "surface_pressure, cloud_cover, weather_code"
)
AIR = "pm2_5, pm10, carbon_monoxide, nitrogen_dioxide, sulphur_dioxide, ozone, us_aqi"


def calendar(ts: str = '"timestamp"') -> str:
    return (
        f"CAST({ts} AS DATE) AS date, "
        + ints(year=f"year({ts})", month=f"month({ts})", day=f"day({ts})", hour=f"hour({ts})")
        + f", dayname({ts}) AS day_of_week"
    )


OBS = f"""{RAW}, obs AS (
  SELECT city, "timestamp", {WEATHER}, {AIR}, {calendar()} FROM raw
)"""

YEARLY = f"""yearly AS (
  SELECT l_returnflag AS city, {ints(year='year(l_shipdate)', month='month(l_shipdate)')},
    l_quantity AS us_aqi, l_discount AS pm2_5, CAST(l_linenumber AS DOUBLE) AS pm10, l_tax AS ozone
  FROM lineitem
)"""

TEXT_TS = 'CAST("timestamp" AS VARCHAR) AS "timestamp"'
FACT_TEXT = f"""city, {TEXT_TS}, {WEATHER}, {AIR},
  CAST(date AS VARCHAR) AS date, year, month, day, hour, day_of_week"""

POLLUTION = ", ".join(
    [avg("us_aqi", "avg_aqi"), avg("pm2_5", "avg_pm2_5"), avg("pm10", "avg_pm10")]
)
VIEW_LEVELS = ", ".join(
    [
        "count(*) AS hourly_observations",
        avg("us_aqi", "avg_aqi"),
        top("us_aqi", "max_aqi"),
        avg("pm2_5", "avg_pm2_5"),
        avg("pm10", "avg_pm10"),
    ]
)


def banded(column: str, edges: list[tuple[str, str]], last: str) -> str:
    whens = " ".join(f"WHEN {column} {edge} THEN '{label}'" for edge, label in edges)
    return f"CASE {whens} ELSE '{last}' END"


CATEGORY = banded(
    "us_aqi",
    [
        ("<= 50", "Good"),
        ("<= 100", "Moderate"),
        ("<= 150", "Unhealthy for Sensitive Groups"),
        ("<= 200", "Unhealthy"),
        ("<= 300", "Very Unhealthy"),
    ],
    "Hazardous",
)
WIND = banded("wind_speed_10m", [("< 5", "0-5"), ("< 10", "5-10"), ("< 15", "10-15"), ("< 20", "15-20")], "20+")
TEMPERATURE = banded(
    "temperature_2m",
    [("< 32", "Below 32 F"), ("< 50", "32-49 F"), ("< 68", "50-67 F"), ("< 86", "68-85 F")],
    "86 F and above",
)

CATEGORIES = f"""categories AS (
  SELECT city, aqi_category, category_order, count(*) AS hours,
    {r2('100.0e0 * count(*) / sum(count(*)) OVER (PARTITION BY city)')} AS pct_city_hours
  FROM (
    SELECT city, {CATEGORY} AS aqi_category,
      CAST(CASE WHEN us_aqi <= 50 THEN 1 WHEN us_aqi <= 100 THEN 2 WHEN us_aqi <= 150 THEN 3
           WHEN us_aqi <= 200 THEN 4 WHEN us_aqi <= 300 THEN 5 ELSE 6 END AS INTEGER) AS category_order
    FROM obs
  ) GROUP BY city, aqi_category, category_order
)"""

HOLES = f"""holes AS (
  SELECT city, CASE WHEN k <> 60 THEN "timestamp" END AS "timestamp", {WEATHER},
    pm2_5, pm10, carbon_monoxide, nitrogen_dioxide, sulphur_dioxide,
    CASE WHEN k <> 50 THEN ozone END AS ozone, CASE WHEN k >= 10 THEN us_aqi END AS us_aqi
  FROM raw
)"""

SPOILT = f"""spoilt AS (
  SELECT city, "timestamp", temperature_2m, relative_humidity_2m * 1.25e0 - 5.0e0 AS relative_humidity_2m,
    precipitation, wind_speed_10m, surface_pressure, cloud_cover, weather_code,
    pm2_5, pm10 - 40.0e0 AS pm10, carbon_monoxide, nitrogen_dioxide, sulphur_dioxide,
    ozone - 3.0e0 AS ozone, us_aqi, hour("timestamp") + 1 AS hour
  FROM (SELECT * REPLACE (CASE WHEN k <> 60 THEN "timestamp" END AS "timestamp") FROM raw)
)"""

# The measures that are not negative.
NON_NEGATIVE = (
    "precipitation",
    "wind_speed_10m",
    "pm2_5",
    "pm10",
    "carbon_monoxide",
    "nitrogen_dioxide",
    "sulphur_dioxide",
    "ozone",
    "us_aqi",
)
EXPECTED_CITIES = "('click'), ('error'), ('purchase'), ('refund'), ('signup')"


def _report() -> str:
    checks = {
        "required_columns": "0",
        "missing_cities": f"(SELECT count(*) FROM (SELECT * FROM (VALUES {EXPECTED_CITIES}) EXCEPT SELECT city FROM spoilt))",
        "unexpected_cities": f"(SELECT count(*) FROM (SELECT city FROM spoilt EXCEPT SELECT * FROM (VALUES {EXPECTED_CITIES})))",
        "unique_keys": """(SELECT coalesce(sum(n), 0) FROM
            (SELECT count(*) AS n FROM spoilt GROUP BY city, "timestamp" HAVING count(*) > 1))""",
        "valid_timestamps": """(SELECT count(*) FROM spoilt WHERE "timestamp" IS NULL)""",
        "starts_as_expected": """(SELECT CASE WHEN min("timestamp") = TIMESTAMP '2024-01-01' THEN 0 ELSE 1 END FROM spoilt)""",
        "ends_as_expected": """(SELECT CASE WHEN max("timestamp") = TIMESTAMP '2024-01-30 23:00:00' THEN 0 ELSE 1 END FROM spoilt)""",
    }
    for column in ("relative_humidity_2m", "cloud_cover"):
        checks[f"percent_{column}"] = f"(SELECT count(*) FROM spoilt WHERE {column} < 0 OR {column} > 100)"
    for column in NON_NEGATIVE:
        checks[f"non_negative_{column}"] = f"(SELECT count(*) FROM spoilt WHERE {column} < 0)"
    rows = " UNION ALL ".join(
        f"SELECT '{name}' AS \"check\", CAST({count} AS BIGINT) AS violations" for name, count in checks.items()
    )
    return f'report AS (SELECT "check", violations, violations = 0 AS passed FROM ({rows}))'


def _broken() -> str:
    rules = {f"{c} is null": f"{c} IS NULL" for c in ("city", '"timestamp"')}
    rules |= {f"{c} is null": '"timestamp" IS NULL' for c in ("date", "year", "month", "day", "hour", "day_of_week")}
    rules |= {f"{c} outside 0..100": f"{c} < 0 OR {c} > 100" for c in ("relative_humidity_2m", "cloud_cover")}
    rules |= {f"{c} negative": f"{c} < 0" for c in NON_NEGATIVE}
    rules["hour outside 0..23"] = "hour < 0 OR hour > 23"
    parts = ", ".join(
        "CASE WHEN {} THEN '{}' END".format(bad, rule.replace('"', "")) for rule, bad in rules.items()
    )
    return f"concat_ws('; ', {parts})"


def _null_profile() -> str:
    columns = ["city", '"timestamp"', *WEATHER.split(", "), *AIR.split(", ")]
    counts = " UNION ALL ".join(
        f"SELECT '{c.strip(chr(34))}' AS \"column\", count(*) - count({c}) AS missing, count(*) AS n FROM holes"
        for c in columns
    )
    return f"""WITH {RAW}, {HOLES} SELECT "column", missing, {r2('100.0e0 * missing / n')} AS pct
        FROM ({counts}) WHERE missing > 0"""


def _exports() -> str:
    sources = [
        ("observations", "hourly_observations.csv", 22, "SELECT 1 FROM obs"),
        ("vw_city_air_quality_summary", "city_air_quality_summary.csv", 9, "SELECT 1 FROM obs GROUP BY city"),
        ("vw_monthly_air_quality", "monthly_air_quality.csv", 9, "SELECT 1 FROM obs GROUP BY city, year, month"),
        ("vw_daily_air_quality", "daily_air_quality.csv", 11, "SELECT 1 FROM obs GROUP BY city, date"),
        ("vw_hourly_patterns", "hourly_patterns.csv", 8, "SELECT 1 FROM obs GROUP BY city, hour"),
        ("vw_aqi_categories", "aqi_categories.csv", 5, "SELECT 1 FROM categories"),
    ]
    return " UNION ALL ".join(
        f"""SELECT '{source}' AS source, '{file}' AS file,
            (SELECT count(*) FROM ({rows})) AS rows, CAST({columns} AS INTEGER) AS columns"""
        for source, file, columns, rows in sources
    )


CITY_SUMMARY = f"""SELECT city, {VIEW_LEVELS}, {avg('ozone', 'avg_ozone')},
  count(*) FILTER (WHERE us_aqi > 100) AS hours_above_aqi_100,
  {r2('100.0e0 * count(*) FILTER (WHERE us_aqi > 100) / count(*)')} AS pct_hours_above_aqi_100
FROM obs GROUP BY city"""

KEPT_FIRST = """CASE WHEN "timestamp" < TIMESTAMP '2024-01-16' THEN us_aqi + 1000.0e0 ELSE us_aqi END"""

ORACLES: dict[str, str] = {
    "city_summary": f"WITH {OBS} {CITY_SUMMARY}",
    "monthly_summary": f"""WITH {YEARLY} SELECT city, year, month, {VIEW_LEVELS}, {avg('ozone', 'avg_ozone')}
        FROM yearly GROUP BY city, year, month""",
    "daily_summary": f"""WITH {OBS} SELECT city, CAST(date AS VARCHAR) AS date, {VIEW_LEVELS},
        {avg('temperature_2m', 'avg_temperature')}, {avg('relative_humidity_2m', 'avg_humidity')},
        {avg('wind_speed_10m', 'avg_wind_speed')}, {r2('sum(precipitation)')} AS total_precipitation
        FROM obs GROUP BY city, obs.date""",
    "hourly_pattern_by_group": f"""WITH {OBS} SELECT city, hour, count(*) AS observations, {POLLUTION},
        {avg('temperature_2m', 'avg_temperature')}, {avg('wind_speed_10m', 'avg_wind_speed')}
        FROM obs GROUP BY city, hour""",
    "category_distribution": f"WITH {OBS}, {CATEGORIES} SELECT * FROM categories",
    "city_overview": f"""WITH {OBS} SELECT city, {POLLUTION}, {top('us_aqi', 'max_aqi')},
        count(*) AS hourly_observations FROM obs GROUP BY city ORDER BY avg_aqi DESC NULLS FIRST, city""",
    "monthly_trend": f"""WITH {YEARLY} SELECT city, month, {POLLUTION}, {top('us_aqi', 'max_aqi')},
        count(*) AS hourly_observations FROM yearly GROUP BY city, month ORDER BY city, month""",
    "worst_months_topk": f"""WITH {YEARLY} SELECT city, year, month, {avg('us_aqi', 'avg_aqi')},
        {avg('pm2_5', 'avg_pm2_5')}, {top('us_aqi', 'max_aqi')} FROM yearly GROUP BY city, year, month
        ORDER BY avg_aqi DESC NULLS FIRST, city, year, month LIMIT 20""",
    "worst_hours_topk": f"""WITH {OBS} SELECT city, CAST(o."timestamp" AS VARCHAR) AS "timestamp", us_aqi, pm2_5, pm10,
        temperature_2m, relative_humidity_2m, wind_speed_10m, precipitation
        FROM obs o ORDER BY us_aqi DESC NULLS FIRST, city, o."timestamp" LIMIT 25""",
    "category_hours_pivot": f"""WITH {OBS} SELECT city,
        count(*) FILTER (WHERE us_aqi <= 50) AS good_hours,
        count(*) FILTER (WHERE us_aqi BETWEEN 51 AND 100) AS moderate_hours,
        count(*) FILTER (WHERE us_aqi BETWEEN 101 AND 150) AS unhealthy_sensitive_hours,
        count(*) FILTER (WHERE us_aqi BETWEEN 151 AND 200) AS unhealthy_hours,
        count(*) FILTER (WHERE us_aqi BETWEEN 201 AND 300) AS very_unhealthy_hours,
        count(*) FILTER (WHERE us_aqi > 300) AS hazardous_hours
        FROM obs GROUP BY city ORDER BY city""",
    "threshold_exceedance": f"""WITH {OBS} SELECT city, count(*) AS total_hours,
        count(*) FILTER (WHERE us_aqi > 100) AS hours_above_100,
        {r2('100.0e0 * count(*) FILTER (WHERE us_aqi > 100) / count(*)')} AS pct_hours_above_100
        FROM obs GROUP BY city ORDER BY hours_above_100 DESC, city""",
    "city_rank": f"""WITH {OBS}, averages AS (
          SELECT city, avg(us_aqi) AS level, avg(pm2_5) AS fine, avg(pm10) AS coarse FROM obs GROUP BY city)
        SELECT rank() OVER (ORDER BY level DESC NULLS FIRST) AS aqi_rank, city,
          {r2('level')} AS avg_aqi, {r2('fine')} AS avg_pm2_5, {r2('coarse')} AS avg_pm10
        FROM averages ORDER BY aqi_rank, city""",
    "hour_of_day": f"WITH {OBS} SELECT hour, {POLLUTION} FROM obs GROUP BY hour ORDER BY hour",
    "hour_by_city": f"""WITH {OBS} SELECT city, hour, {avg('us_aqi', 'avg_aqi')}, {avg('pm2_5', 'avg_pm2_5')}
        FROM obs GROUP BY city, hour ORDER BY city, hour""",
    "weekday_pattern": f"""WITH {OBS} SELECT day_of_week, {avg('us_aqi', 'avg_aqi')}, {avg('pm2_5', 'avg_pm2_5')},
        count(*) AS hourly_observations FROM obs GROUP BY day_of_week ORDER BY avg_aqi DESC NULLS FIRST, day_of_week""",
    "wind_bands": f"""WITH {OBS} SELECT {WIND} AS wind_speed_group, count(*) AS observations, {POLLUTION}
        FROM obs GROUP BY 1 ORDER BY min(wind_speed_10m)""",
    "dry_wet": f"""WITH {OBS} SELECT CASE WHEN precipitation > 0 THEN 'Rain / Precipitation' ELSE 'Dry' END
          AS weather_condition, count(*) AS observations, {POLLUTION}
        FROM obs GROUP BY 1 ORDER BY avg_aqi DESC NULLS FIRST""",
    "temperature_bands": f"""WITH {OBS} SELECT {TEMPERATURE} AS temperature_range, count(*) AS observations,
        {avg('us_aqi', 'avg_aqi')}, {avg('pm2_5', 'avg_pm2_5')}, {avg('ozone', 'avg_ozone')}
        FROM obs GROUP BY 1 ORDER BY min(temperature_2m)""",
    "period_over_period": f"""WITH {YEARLY}, averages AS (
          SELECT city, year, month, avg(us_aqi) AS level FROM yearly GROUP BY city, year, month),
        changes AS (SELECT *, lag(level) OVER (PARTITION BY city ORDER BY year, month) AS previous FROM averages)
        SELECT city, year, month, {r2('level')} AS avg_aqi, {r2('previous')} AS previous_month_aqi,
          {r2('level - previous')} AS aqi_change FROM changes ORDER BY city, year, month""",
    "day_over_day": f"""WITH {OBS}, averages AS (
          SELECT city, date AS d, avg(us_aqi) AS level FROM obs GROUP BY city, date),
        changes AS (SELECT *, lag(level) OVER (PARTITION BY city ORDER BY d) AS previous FROM averages)
        SELECT city, CAST(d AS VARCHAR) AS date, {r2('level')} AS avg_aqi, {r2('previous')} AS previous_day_aqi,
          {r2('level - previous')} AS aqi_change FROM changes ORDER BY city, d""",
    "worst_day_per_group": f"""WITH {OBS}, averages AS (
          SELECT city, date AS d, avg(us_aqi) AS level, avg(pm2_5) AS fine, max(us_aqi) AS high FROM obs GROUP BY city, date),
        placed AS (SELECT *, row_number() OVER (PARTITION BY city ORDER BY level DESC NULLS FIRST, d) AS place FROM averages)
        SELECT city, CAST(d AS VARCHAR) AS date, {r2('level')} AS avg_aqi, {r2('fine')} AS avg_pm2_5, {r2('high')} AS max_aqi
        FROM placed WHERE place = 1 ORDER BY avg_aqi DESC, city""",
    "registered_views": f"""WITH {OBS}, {CATEGORIES}, summary AS ({CITY_SUMMARY})
        SELECT c.city, c.hours AS hazardous_hours, s.hourly_observations, s.avg_aqi
        FROM categories c JOIN summary s ON c.city = s.city WHERE c.aqi_category = 'Hazardous'""",
    "payload_explode": f"WITH {RAW} SELECT city, {TEXT_TS}, {WEATHER} FROM raw",
    "payload_array_length_check": """SELECT event_type AS city, event_id // 1000 AS chunk, 'length' AS problem,
        'wind_speed_10m' AS variable FROM events WHERE event_type = 'view' GROUP BY 1, 2""",
    "payload_required_keys": """SELECT event_type AS city, event_id // 1000 AS chunk, 'missing' AS problem,
        'ozone' AS variable FROM events WHERE event_type = 'click' GROUP BY 1, 2""",
    "parse_timestamp_lenient": """WITH texts AS (
          SELECT event_id, CASE event_type WHEN 'error' THEN 'not a time' WHEN 'signup' THEN NULL
            ELSE CAST(ts AS VARCHAR) END AS t FROM events)
        SELECT event_id, CAST(TRY_CAST(t AS TIMESTAMP) AS VARCHAR) AS "timestamp"
        FROM texts WHERE TRY_CAST(t AS TIMESTAMP) IS NOT NULL""",
    "calendar_features": f"""SELECT o_orderkey, CAST(date AS VARCHAR) AS date, year, month, day, hour, day_of_week
        FROM (SELECT o_orderkey, {calendar('o_orderdate')} FROM orders)""",
    "city_slug": "SELECT p_partkey, replace(lower(p_name), ' ', '_') AS slug FROM part",
    "clean_observations": f"WITH {OBS} SELECT {FACT_TEXT} FROM obs WHERE weather_code >= 10",
    "concat_sources": """SELECT c_name AS name, c_nationkey AS nation, c_acctbal AS balance FROM customer
        UNION ALL SELECT s_name, s_nationkey, s_acctbal FROM supplier""",
    "drop_exact_duplicates": "SELECT DISTINCT l_returnflag, l_linestatus, l_linenumber, l_tax FROM lineitem",
    "latest_per_key": """SELECT event_type, user_id, CAST(e.ts AS VARCHAR) AS ts, event_id, value FROM (
          SELECT *, row_number() OVER (PARTITION BY event_type, user_id ORDER BY ts DESC, event_id DESC) AS place
          FROM events) e WHERE place = 1""",
    "nan_to_null": f"""WITH {RAW} SELECT event_id, CASE WHEN k >= 10 THEN us_aqi END AS us_aqi,
        CASE WHEN k < 90 THEN pm2_5 END AS pm2_5, ozone FROM raw""",
    "attach_location": """SELECT c_custkey, c_name, n_nationkey, n_name, n_regionkey
        FROM customer JOIN nation ON c_nationkey = n_nationkey""",
    "ingestion_coverage": """SELECT o_orderkey, o_orderpriority, count(l_orderkey) > 0 AS landed, count(l_orderkey) AS records
        FROM orders LEFT JOIN lineitem ON o_orderkey = l_orderkey GROUP BY o_orderkey, o_orderpriority""",
    "ingestion_totals": """SELECT count(*) AS members, count(*) FILTER (WHERE records > 0) AS landed,
        count(*) FILTER (WHERE records = 0) AS absent, CAST(sum(records) AS BIGINT) AS records
        FROM (SELECT o_orderkey, count(l_orderkey) AS records FROM orders LEFT JOIN lineitem ON o_orderkey = l_orderkey
          GROUP BY o_orderkey)""",
    "merged_observations": f"WITH {OBS} SELECT {FACT_TEXT} FROM obs",
    "merge_one_to_one": """SELECT o_orderkey, o_totalprice, o_orderpriority, lines, max_quantity
        FROM orders JOIN (SELECT l_orderkey, count(*) AS lines, max(l_quantity) AS max_quantity
          FROM lineitem GROUP BY l_orderkey) ON o_orderkey = l_orderkey""",
    "missing_members": "SELECT o_orderkey FROM orders EXCEPT SELECT l_orderkey FROM lineitem",
    "unexpected_members": """SELECT l_orderkey AS o_orderkey FROM lineitem
        EXCEPT SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'P'""",
    "duplicate_key_stats": """SELECT count(*) FILTER (WHERE n > 1) AS duplicate_groups,
        CAST(coalesce(sum(n - 1) FILTER (WHERE n > 1), 0) AS BIGINT) AS excess_rows,
        CAST(coalesce(sum(n) FILTER (WHERE n > 1), 0) AS BIGINT) AS rows_in_groups
        FROM (SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber)""",
    "null_profile": _null_profile(),
    "dataset_profile": f"""WITH {RAW}, {HOLES} SELECT count(*) AS rows, CAST(22 AS INTEGER) AS columns,
        count(DISTINCT city) AS cities,
        CAST(min("timestamp") AS VARCHAR) AS start_timestamp, CAST(max("timestamp") AS VARCHAR) AS end_timestamp,
        (SELECT CAST(coalesce(sum(n - 1), 0) AS BIGINT) FROM
          (SELECT count(*) AS n FROM holes GROUP BY city, "timestamp")) AS duplicate_keys,
        CAST(7 * (count(*) - count("timestamp")) + (count(*) - count(us_aqi)) + (count(*) - count(ozone)) AS BIGINT)
          AS missing_values FROM holes""",
    "rows_by_city": f"WITH {RAW} SELECT city, count(*) AS rows FROM raw WHERE k >= 10 GROUP BY city ORDER BY city",
    "quality_report": f"WITH {RAW}, {SPOILT}, {_report()} SELECT * FROM report",
    "quality_verdict": f"""WITH {RAW}, {SPOILT}, {_report()}
        SELECT bool_and(passed) AS passed, count(*) FILTER (WHERE NOT passed) AS failed_checks FROM report""",
    "range_violations": "SELECT c_custkey, c_acctbal FROM customer WHERE c_acctbal < 0",
    "constraint_quarantine": f"""WITH {RAW}, {SPOILT}, judged AS (SELECT *, {_broken()} AS broken_rules FROM spoilt)
        SELECT city, CAST(j."timestamp" AS VARCHAR) AS "timestamp", us_aqi, broken_rules
        FROM judged j WHERE broken_rules <> ''""",
    "idempotent_append": f"""WITH {OBS}, kept AS (SELECT * REPLACE ({KEPT_FIRST} AS us_aqi) FROM obs)
        SELECT {FACT_TEXT} FROM kept""",
    "append_counts": f"""WITH {OBS} SELECT count(*) FILTER (WHERE "timestamp" < TIMESTAMP '2024-01-16') AS rows_before,
        count(*) FILTER (WHERE "timestamp" >= TIMESTAMP '2024-01-16') AS inserted, count(*) AS rows_after FROM obs""",
    "post_load_verify": f"""WITH {OBS} SELECT count(*) AS expected_rows, count(*) AS rows, count(DISTINCT city) AS cities,
        CAST(min("timestamp") AS VARCHAR) AS start_timestamp, CAST(max("timestamp") AS VARCHAR) AS end_timestamp,
        CAST(0 AS BIGINT) AS duplicate_groups, true AS passed FROM obs""",
    "csv_roundtrip": f"WITH {OBS} SELECT {FACT_TEXT} FROM obs",
    "csv_roundtrip_lenient": f"WITH {RAW}, {HOLES} SELECT city, {TEXT_TS}, {WEATHER}, {AIR} FROM holes",
    "export_manifest": f"WITH {OBS}, {CATEGORIES} {_exports()}",
    "export_summary": f"""WITH {OBS}, {CATEGORIES} SELECT count(*) AS files, CAST(sum(rows) AS BIGINT) AS total_rows
        FROM ({_exports()})""",
    "payloads_to_summary": f"WITH {OBS} {CITY_SUMMARY}",
    "monthly_trend_default": f"""WITH {YEARLY} SELECT city, year, month, {POLLUTION}, {top('us_aqi', 'max_aqi')},
        count(*) AS hourly_observations FROM yearly GROUP BY city, year, month""",
    "worst_months_default": f"""WITH {YEARLY} SELECT city, year, month, {avg('us_aqi', 'avg_aqi')},
        {avg('pm2_5', 'avg_pm2_5')}, {top('us_aqi', 'max_aqi')} FROM yearly GROUP BY city, year, month
        ORDER BY avg_aqi DESC NULLS FIRST, city, year, month LIMIT 20""",
    "csv_unreadable_values": f"""WITH {RAW} SELECT c.name AS "column", CASE c.name
          WHEN 'us_aqi' THEN (SELECT count(*) FROM raw WHERE k % 10 = 3)
          WHEN 'ozone' THEN (SELECT count(*) FROM raw WHERE k = 50)
          WHEN 'weather_code' THEN (SELECT count(*) FROM raw WHERE k % 4 = 1) ELSE 0 END AS unreadable
        FROM (SELECT unnest(string_split('{WEATHER}, {AIR}, date, year, month, day, hour', ', ')) AS name) c""",
    "csv_decimal_codes": f"WITH {OBS} SELECT {FACT_TEXT} FROM obs",
    "load_with_quarantine": f"""WITH {OBS} SELECT count(*) FILTER (WHERE pm10 >= 40) AS kept, count(*) FILTER (WHERE pm10 < 40) AS set_aside,
        CAST(0 AS BIGINT) AS reloaded, count(*) FILTER (WHERE pm10 < 40) AS quarantined FROM obs""",
    "load_verify_detects": f"""WITH {OBS} SELECT count(*) AS expected_rows, CAST(count(*) + count(*) FILTER (WHERE weather_code < 10) AS BIGINT) AS rows,
        count(DISTINCT city) AS cities, CAST(min("timestamp") AS VARCHAR) AS start_timestamp,
        CAST(max("timestamp") AS VARCHAR) AS end_timestamp, count(*) FILTER (WHERE weather_code < 10) AS duplicate_groups, false AS passed FROM obs""",
    "payload_files_latest": f"""WITH {RAW} SELECT city || ' ' || (event_id // 1000) AS city, count(*) AS hours, min(us_aqi) AS lowest, max(us_aqi) AS highest
        FROM raw GROUP BY raw.city, event_id // 1000""",
    "payload_files_recent": f"""WITH {RAW} SELECT city || ' ' || (event_id // 1000) AS city, count(*) AS hours, min(us_aqi + 500.0e0) AS lowest,
        max(us_aqi + 500.0e0) AS highest FROM raw GROUP BY raw.city, event_id // 1000""",
    "transform_files": f"WITH {OBS} SELECT {FACT_TEXT} FROM obs",
    "coverage_files": f"""WITH {RAW} SELECT city || ' ' || (event_id // 1000) AS city, true AS landed,
        CASE WHEN (event_id // 1000) % 3 = 1 THEN 0 ELSE count(*) END AS records, (event_id // 1000) % 3 <> 1 AS readable
        FROM raw GROUP BY raw.city, event_id // 1000 UNION ALL SELECT 'nowhere 0', false, 0, false""",
    "validation_details": f"""WITH {RAW}, {SPOILT}, {_report()}, wanted(city) AS (VALUES {EXPECTED_CITIES}), n AS (SELECT count(*) AS n FROM spoilt WHERE "timestamp" IS NULL)
        SELECT 'missing city' AS kind, city AS name, CAST(1 AS BIGINT) AS value FROM wanted WHERE city NOT IN (SELECT city FROM spoilt)
        UNION ALL SELECT DISTINCT 'unexpected city', city, CAST(1 AS BIGINT) FROM spoilt WHERE city NOT IN (SELECT city FROM wanted)
        UNION ALL SELECT 'missing value', c, n.n FROM n, unnest(['timestamp', 'date', 'year', 'month', 'day', 'hour', 'day_of_week']) AS x(c) WHERE n.n > 0
        UNION ALL SELECT 'rows', city, count(*) FROM spoilt GROUP BY city
        UNION ALL SELECT 'failed checks', 'all', count(*) FILTER (WHERE NOT passed) FROM report""",
    "table_probe": "SELECT false AS before, true AS after, count(*) AS rows FROM events",
    "configured_locations": """SELECT l.city, l.latitude, l.longitude, l.slug, count(n_nationkey) AS nations FROM (VALUES
        (0, 'Chicago', 41.8781::DOUBLE, -87.6298::DOUBLE, 'chicago'), (1, 'Denver', 39.7392, -104.9903, 'denver'), (2, 'Houston', 29.7604, -95.3698, 'houston'),
        (3, 'Los Angeles', 34.0522, -118.2437, 'los_angeles'), (4, 'New York', 40.7128, -74.0060, 'new_york'), (5, 'Phoenix', 33.4484, -112.0740, 'phoenix'),
        (6, 'Salt Lake City', 40.7608, -111.8910, 'salt_lake_city'), (7, 'Seattle', 47.6062, -122.3321, 'seattle')) AS l(place, city, latitude, longitude, slug)
        LEFT JOIN nation ON n_nationkey % 8 = place GROUP BY ALL""",
}
