"""Data-quality checks, profiles and row constraints."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass, field
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F

from skylog.functions.numeric import round2
from skylog.functions.time import wall_clock
from skylog.operators.joins import missing_members, unexpected_members
from skylog.schemas import (
    CALENDAR_RANGES,
    FACT_COLUMNS,
    KEY,
    LOCATIONS,
    MAX_LENGTHS,
    NON_NEGATIVE_MEASURES,
    NOT_NULL_COLUMNS,
    PERCENT_MEASURES,
)
from skylog.session import scratch_path, small_frame


@dataclass(frozen=True)
class Expectations:
    """What a complete dataset looks like; the defaults are the configured year and cities.

    ``cities`` may be a frame with a column ``city`` instead, for more names
    than a driver should list.
    """

    cities: tuple[str, ...] | DataFrame = tuple(name for name, _, _ in LOCATIONS)
    start: datetime | None = datetime(2025, 1, 1, 0, 0)
    end: datetime | None = datetime(2025, 12, 31, 23, 0)
    columns: tuple[str, ...] = FACT_COLUMNS
    percent: tuple[str, ...] = PERCENT_MEASURES
    non_negative: tuple[str, ...] = NON_NEGATIVE_MEASURES
    key: tuple[str, ...] = field(default=KEY)


REPORT_SCHEMA = "check string, violations bigint, passed boolean"


def out_of_range(column: str, low: float | None = None, high: float | None = None) -> Column:
    """True for a value outside the closed range; null for null, so that a missing value passes."""
    value = F.col(column)
    bounds = [value < low] if low is not None else []
    bounds += [value > high] if high is not None else []
    return reduce(Column.__or__, bounds)


def duplicate_stats(df: DataFrame, keys: Sequence[str] = KEY) -> DataFrame:
    """Repeated keys counted three ways: groups, rows beyond the first, and all rows concerned.

    Null is a key value like any other. Copies collapse before the shuffle.
    """
    copies = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    repeated = F.col("_n") > 1
    return copies.agg(
        F.count_if(repeated).alias("duplicate_groups"),
        _sum_if(repeated, F.col("_n") - 1).alias("excess_rows"),
        _sum_if(repeated, F.col("_n")).alias("rows_in_groups"),
    )


def _sum_if(condition: Column, value: Column) -> Column:
    return F.coalesce(F.sum(F.when(condition, value)), F.lit(0))


def quality_report(
    df: DataFrame, expected: Expectations = Expectations(), rules: dict[str, Column] | None = None
) -> DataFrame:
    """One row per check: ``check, violations, passed``.

    With ``rules`` the rows that break any of them are one more check.

    Missing columns end the report, since the other checks need them. The value
    checks share one pass without a shuffle of rows; uniqueness and the city
    sets share a second one that reads the key columns only.
    """
    spark = df.sparkSession
    missing = [c for c in expected.columns if c not in df.columns]
    columns_row = small_frame(spark, [("required_columns", len(missing), not missing)], REPORT_SCHEMA)
    if missing:
        return columns_row
    return columns_row.unionByName(_key_checks(df, expected)).unionByName(_value_checks(df, expected, rules))


def value_checks(expected: Expectations, rules: dict[str, Column] | None = None, of: Column | None = None) -> dict[str, Column]:
    """Violations per check that looks at rows one by one, as aggregates; with ``of`` only of the rows that it is true for."""
    among = (lambda bad: bad) if of is None else (lambda bad: of & bad)
    timestamp = F.col("timestamp") if of is None else F.when(of, F.col("timestamp"))
    checks: dict[str, Column] = {"valid_timestamps": F.count_if(among(F.col("timestamp").isNull()))}
    if expected.start is not None:
        start = F.min(timestamp).eqNullSafe(wall_clock(expected.start))
        checks["starts_as_expected"] = F.when(start, 0).otherwise(1).cast("bigint")
    if expected.end is not None:
        end = F.max(timestamp).eqNullSafe(wall_clock(expected.end))
        checks["ends_as_expected"] = F.when(end, 0).otherwise(1).cast("bigint")
    for column in expected.percent:
        checks[f"percent_{column}"] = F.count_if(among(out_of_range(column, 0, 100)))
    for column in expected.non_negative:
        checks[f"non_negative_{column}"] = F.count_if(among(out_of_range(column, 0)))
    if rules:
        checks["row_constraints"] = F.count_if(among(breaks_any(rules)))
    return checks


def _value_checks(df: DataFrame, expected: Expectations, rules: dict[str, Column] | None) -> DataFrame:
    checks = value_checks(expected, rules)
    return _as_rows(df.agg(*[c.alias(name) for name, c in checks.items()]), checks)


def _key_checks(df: DataFrame, expected: Expectations) -> DataFrame:
    """Uniqueness, missing and unexpected cities in one cascade: key, city, all."""
    return city_checks(city_counts(df, expected.key), expected)


def city_counts(df: DataFrame, keys: Sequence[str] = KEY) -> DataFrame:
    """``city, rows, repeated`` per city, null too: its rows, and those whose key occurs more than once."""
    copies = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    return copies.groupBy(F.col(keys[0]).alias("city")).agg(F.sum("_n").alias("rows"), _sum_if(F.col("_n") > 1, F.col("_n")).alias("repeated"))


def city_checks(counts: DataFrame, expected: Expectations) -> DataFrame:
    """The checks on keys and cities from the counts per city."""
    wanted = expected_cities(counts.sparkSession, expected).select("city", F.lit(True).alias("_expected"))
    both = counts.withColumn("_actual", F.lit(True)).join(wanted, "city", "full_outer")
    checks = {
        "missing_cities": F.count_if(F.col("_actual").isNull()),
        "unexpected_cities": F.count_if(F.col("_expected").isNull() & F.col("city").isNotNull()),
        "unique_keys": F.coalesce(F.sum("repeated"), F.lit(0)),
    }
    return _as_rows(both.agg(*[c.alias(name) for name, c in checks.items()]), checks)


def load_state(batch: DataFrame, table: DataFrame | None, expected: Expectations | None, keys: Sequence[str] = KEY) -> Row:
    """What the keys of a batch and of the table say before a load, from one pass over both and one shuffle.

    ``missing_cities, unexpected_cities, unique_keys`` are the checks on the
    batch; ``inserts`` its keys that the table does not have; ``rows_before``
    and ``duplicate_groups`` are those of the table; ``cities`` are in either.
    """
    city = keys[0]
    tagged = batch.select(*keys, F.lit(1).alias("_new"), F.lit(0).alias("_old"))
    if table is not None:
        tagged = tagged.unionByName(table.select(*keys, F.lit(0).alias("_new"), F.lit(1).alias("_old")))
    new, old = F.col("_new"), F.col("_old")
    per_key = tagged.groupBy(*keys).agg(F.sum("_new").alias("_new"), F.sum("_old").alias("_old"))
    per_city = per_key.groupBy(F.col(city).alias("city")).agg(
        F.max(new > 0).alias("_actual"),
        _sum_if(new > 1, new).alias("_repeated"),
        F.count_if((new > 0) & (old == 0)).alias("_inserts"),
        F.sum("_old").alias("_rows"),
        F.count_if(old > 1).alias("_groups"),
    )
    known = F.col("_groups").isNotNull()
    counts = [
        F.coalesce(F.sum("_repeated"), F.lit(0)).alias("unique_keys"),
        F.coalesce(F.sum("_inserts"), F.lit(0)).alias("inserts"),
        F.coalesce(F.sum("_rows"), F.lit(0)).alias("rows_before"),
        F.coalesce(F.sum("_groups"), F.lit(0)).alias("duplicate_groups"),
        F.count_if(known & F.col("city").isNotNull()).alias("cities"),
    ]
    if expected is not None:
        wanted = expected_cities(batch.sparkSession, expected).select("city", F.lit(True).alias("_expected"))
        per_city = per_city.join(wanted, "city", "full_outer")
        actual = F.coalesce("_actual", F.lit(False))
        counts += [
            F.count_if(F.col("_expected") & ~actual).alias("missing_cities"),
            F.count_if(F.col("_expected").isNull() & actual & F.col("city").isNotNull()).alias("unexpected_cities"),
        ]
    return per_city.agg(*counts).first()


def _as_rows(counts: DataFrame, names: Iterable[str]) -> DataFrame:
    """One row of counts turned into one row per count."""
    entries = [F.struct(F.lit(n).alias("check"), F.col(n).alias("violations")) for n in names]
    return counts.select(F.inline(F.array(*entries))).withColumn("passed", F.col("violations") == 0)


def verdict(report: DataFrame) -> DataFrame:
    """Whether every check passed, as one row."""
    return report.agg(
        F.coalesce(F.min("passed"), F.lit(True)).alias("passed"),
        F.count_if(~F.col("passed")).alias("failed_checks"),
    )


def null_profile(df: DataFrame) -> DataFrame:
    """Missing values per column that has any: ``column, missing, pct``, most first. One pass."""
    counts = df.agg(F.count(F.lit(1)).alias("_rows"), *[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
    entries = [F.struct(F.lit(c).alias("column"), F.col(c).alias("missing")) for c in df.columns]
    return missing_shares(counts.select("_rows", F.inline(F.array(*entries))))


def missing_shares(counts: DataFrame) -> DataFrame:
    """``column, missing, pct`` from ``column, missing, _rows``."""
    share = round2(F.lit(100.0) * F.col("missing") / F.col("_rows")).alias("pct")
    return counts.where("missing > 0").select("column", "missing", share).orderBy(F.desc("missing"), "column")


def dataset_profile(df: DataFrame, keys: Sequence[str] = KEY) -> DataFrame:
    """Rows, columns, cities, time bounds, repeated keys and missing values, as one row.

    One scan: counted per key, then per city, then overall.
    """
    city, timestamp = keys
    missing = reduce(Column.__add__, [F.col(c).isNull().cast("bigint") for c in df.columns])
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), F.sum(missing).alias("_missing"))
    per_city = per_key.groupBy(city).agg(
        F.sum("_n").alias("_rows"),
        F.sum(F.col("_n") - 1).alias("_excess"),
        F.sum("_missing").alias("_missing"),
        F.min(timestamp).alias("_start"),
        F.max(timestamp).alias("_end"),
    )
    return per_city.agg(
        F.coalesce(F.sum("_rows"), F.lit(0)).alias("rows"),
        F.lit(len(df.columns)).alias("columns"),
        F.count(city).alias("cities"),
        F.min("_start").alias("start_timestamp"),
        F.max("_end").alias("end_timestamp"),
        F.coalesce(F.sum("_excess"), F.lit(0)).alias("duplicate_keys"),
        F.coalesce(F.sum("_missing"), F.lit(0)).alias("missing_values"),
    )


def rows_by_city(df: DataFrame, city: str = "city") -> DataFrame:
    """Rows per known city in order of the name."""
    return df.where(F.col(city).isNotNull()).groupBy(city).agg(F.count(F.lit(1)).alias("rows")).orderBy(city)


def fact_constraints() -> dict[str, Column]:
    """Name of every row constraint of the fact, with the condition that breaks it."""
    rules = {f"{c} is null": F.col(c).isNull() for c in NOT_NULL_COLUMNS}
    rules |= {f"{c} outside 0..100": out_of_range(c, 0, 100) for c in PERCENT_MEASURES}
    rules |= {f"{c} negative": out_of_range(c, 0) for c in NON_NEGATIVE_MEASURES}
    rules |= {f"{c} outside {lo}..{hi}": out_of_range(c, lo, hi) for c, (lo, hi) in CALENDAR_RANGES.items()}
    rules |= {f"{c} longer than {n}": F.char_length(c) > n for c, n in MAX_LENGTHS.items()}
    rules |= {f"{c} is not that of timestamp": F.col(c) != part("timestamp") for c, part in (("year", F.year), ("month", F.month))}
    return rules


def breaks_any(rules: dict[str, Column]) -> Column:
    """True for a row that breaks a constraint; a condition that is null is not broken."""
    return F.coalesce(reduce(Column.__or__, rules.values()), F.lit(False))


def with_broken_rules(df: DataFrame, rules: dict[str, Column] | None = None, name: str = "broken_rules") -> DataFrame:
    """Add the names of the constraints a row breaks; a condition that is null is not broken."""
    rules = fact_constraints() if rules is None else rules
    broken = F.array_compact(F.array(*[F.when(bad, F.lit(rule)) for rule, bad in rules.items()]))
    return df.withColumn(name, broken)


def split_by_rules(df: DataFrame, rules: dict[str, Column] | None = None) -> tuple[DataFrame, DataFrame]:
    """The rows that keep all constraints, and the others with ``broken_rules``, the names of those they break.

    Rows are judged once and written to the shared folder by their verdict; each
    half reads its own folder.
    """
    return stage_by_rules(df, scratch_path(df.sparkSession, "judged"), rules)


def stage_by_rules(
    df: DataFrame, path: str, rules: dict[str, Column] | None = None, observe: tuple[Observation, dict[str, Column]] | None = None, verdict: str = "_refused"
) -> tuple[DataFrame, DataFrame]:
    """``split_by_rules`` at a path of the caller's; aggregates over the judged rows are observed on the way.

    A condition on a scan or a filter is evaluated for every rule apart from the
    others. In a projection a column of the input is made once for all of them,
    and the verdict is one more column, which the write partitions by.
    """
    while verdict in df.columns:
        verdict = f"_{verdict}"
    judged = with_broken_rules(df, rules).withColumn(verdict, F.size("broken_rules") > 0)
    written = judged.observe(observe[0], *[c.alias(name) for name, c in observe[1].items()]) if observe else judged
    written.write.partitionBy(verdict).parquet(path)
    staged = df.sparkSession.read.schema(judged.schema).parquet(path)
    refused = F.col(verdict)
    return staged.where(~refused).select(*df.columns), staged.where(refused).select(*df.columns, "broken_rules")


def load_check(fact: DataFrame, expected_rows: int | None, city_count: int | None = None, keys: Sequence[str] = KEY) -> DataFrame:
    """State of a loaded table against expected rows and cities and unique keys, as one row.

    The expected numbers must come from elsewhere than the table; None checks
    nothing. Groups by key: pass the part of the table that can have changed.
    """
    city, timestamp = keys
    per_city = (
        fact.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("_n"))
        .groupBy(city)
        .agg(
            F.sum("_n").alias("_rows"),
            F.count_if(F.col("_n") > 1).alias("_groups"),
            F.min(timestamp).alias("_start"),
            F.max(timestamp).alias("_end"),
        )
    )
    state = per_city.agg(
        F.lit(expected_rows).cast("bigint").alias("expected_rows"),
        F.coalesce(F.sum("_rows"), F.lit(0)).alias("rows"),
        F.count(city).alias("cities"),
        F.min("_start").alias("start_timestamp"),
        F.max("_end").alias("end_timestamp"),
        F.coalesce(F.sum("_groups"), F.lit(0)).alias("duplicate_groups"),
    )
    good = F.col("duplicate_groups") == 0
    if expected_rows is not None:
        good = good & (F.col("rows") == F.col("expected_rows"))
    if city_count is not None:
        good = good & (F.col("cities") == city_count)
    return state.withColumn("passed", good)


def expected_cities(spark: SparkSession, expected: Expectations) -> DataFrame:
    """The expected cities as a frame, each once."""
    if isinstance(expected.cities, DataFrame):
        return expected.cities.select("city").distinct()
    return small_frame(spark, [(c,) for c in expected.cities], "city string")


def missing_cities(df: DataFrame, expected: Expectations = Expectations()) -> DataFrame:
    """Expected cities without a row, by name."""
    return missing_members(expected_cities(df.sparkSession, expected), df, ["city"]).orderBy("city")


def unexpected_cities(df: DataFrame, expected: Expectations = Expectations()) -> DataFrame:
    """Cities that occur but are not expected, by name."""
    return unexpected_members(expected_cities(df.sparkSession, expected), df, ["city"]).orderBy("city")
