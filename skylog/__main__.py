"""Command line of the jobs.

    python -m skylog transform --weather DIR --air-quality DIR --output PATH
    python -m skylog validate  --input PATH
    python -m skylog load      --input PATH --fact PATH
    python -m skylog analyze   --fact PATH [--question NAME ...]
    python -m skylog export    --fact PATH --output DIR
    python -m skylog coverage  --payloads DIR --source weather|air_quality [--recent]

Results are previewed on the console; ``--output-folder`` writes all of them.
On a cluster hand this module to ``spark-submit``.
"""

from __future__ import annotations

import argparse
import os
import sys
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession

from skylog.functions.text import slug
from skylog.operators.joins import coverage_totals
from skylog.operators.quality import Expectations
from skylog.plans.export import export
from skylog.plans.load import load
from skylog.plans.transform import ingestion_coverage, transform
from skylog.plans.validate import validate
from skylog.plans.views import QUESTIONS, VIEWS
from skylog.schemas import AIR_MEASURES, LOCATION, WEATHER_MEASURES
from skylog.session import build_session, drop_scratch, small_frame
from skylog.sinks import write_csv
from skylog.sources import PayloadFolder, csv_unreadable, locations, read_csv_lenient, read_csv_strict, read_fact


def _cities(spark: SparkSession, args) -> DataFrame:
    if args.locations is None:
        return locations(spark)
    listed = spark.read.csv(args.locations, schema=LOCATION, header=True)
    return listed.withColumn("slug", slug(listed.city))


def _expectations(spark: SparkSession, args) -> Expectations:
    return Expectations(cities=_cities(spark, args), start=args.start, end=args.end)


def _give(frame: DataFrame, name: str, args) -> None:
    """All rows to ``--output`` where it is given; the console shows a preview and says when there is more."""
    if args.output_folder:
        write_csv(frame, os.path.join(args.output_folder, name))
    seen = frame.take(args.rows + 1)
    print(name)
    small_frame(frame.sparkSession, [tuple(r) for r in seen[: args.rows]], frame.schema).show(args.rows, truncate=False)
    if len(seen) > args.rows:
        print(f"preview: the first {args.rows} rows; " + (f"all are in {args.output_folder}/{name}" if args.output_folder else "--output-folder writes all"))


def _transform(spark, args) -> int:
    result = transform(
        spark, args.weather, args.air_quality, args.output, _cities(spark, args), args.null_arrays, args.format
    )
    _give(result.profile, "profile", args)
    _give(result.rows_by_city, "rows_by_city", args)
    return 0


def _validate(spark, args) -> int:
    csv = args.format == "csv"
    df = read_csv_lenient(spark, args.input) if csv else read_fact(spark, args.input)
    result = validate(df, _expectations(spark, args), csv_unreadable(spark, args.input) if csv else None)
    frames = {"report": result.report_frame(spark)}
    frames |= {n: f for n in ("missing_cities", "unexpected_cities", "missing_values", "rows_by_city") if (f := getattr(result, n)) is not None}
    for name, frame in frames.items():
        _give(frame, name, args)
    print("passed" if result.passed else f"failed checks: {result.failed_checks}")
    return 0 if result.passed else 1


def _load(spark, args) -> int:
    batch = read_csv_strict(spark, args.input) if args.format == "csv" else read_fact(spark, args.input)
    result = load(batch, args.fact, _expectations(spark, args), quarantine=args.quarantine)
    result.counts.show()
    print(result.check.asDict())
    return 0


def _analyze(spark, args) -> int:
    fact = read_fact(spark, args.fact)
    asked = {**VIEWS, **QUESTIONS}
    for name in args.question or QUESTIONS:
        _give(asked[name](fact), name, args)
    return 0


def _export(spark, args) -> int:
    result = export(read_fact(spark, args.fact), args.output, written=True)
    result.manifest.show(truncate=False)
    result.summary.show()
    return 0


def _coverage(spark, args) -> int:
    measures = WEATHER_MEASURES if args.source == "weather" else AIR_MEASURES
    report = ingestion_coverage(spark, PayloadFolder(args.payloads, measures, args.recent), _cities(spark, args))
    _give(report.orderBy("city"), "coverage", args)
    _give(coverage_totals(report), "coverage_totals", args)
    return 0


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="skylog")
    jobs = parser.add_subparsers(dest="job", required=True)

    def job(name, run, **paths):
        sub = jobs.add_parser(name)
        sub.set_defaults(run=run)
        sub.add_argument("--output-folder", help="write every result in full here, a CSV folder each")
        sub.add_argument("--rows", type=int, default=20, help="rows of each result shown on the console")
        for option, required in paths.items():
            sub.add_argument("--" + option.replace("_", "-"), required=required)
        return sub

    def with_format(sub):
        sub.add_argument("--format", choices=("parquet", "csv"), default="parquet")

    def with_cities(sub):
        sub.add_argument("--locations", help="CSV with city, latitude, longitude; default: the configured cities")

    def with_bounds(sub):
        sub.add_argument("--start", type=datetime.fromisoformat, default=Expectations().start)
        sub.add_argument("--end", type=datetime.fromisoformat, default=Expectations().end)

    sub = job("transform", _transform, weather=True, air_quality=True, output=True)
    sub.add_argument("--null-arrays", choices=("reject", "keep"), default="reject")
    with_format(sub)
    with_cities(sub)
    for sub in (job("validate", _validate, input=True), job("load", _load, input=True, fact=True, quarantine=False)):
        with_format(sub)
        with_cities(sub)
        with_bounds(sub)
    sub = job("analyze", _analyze, fact=True)
    sub.add_argument("--question", nargs="*", choices=[*VIEWS, *QUESTIONS])
    job("export", _export, fact=True, output=True)
    sub = job("coverage", _coverage, payloads=True)
    sub.add_argument("--source", choices=("weather", "air_quality"), required=True)
    sub.add_argument("--recent", action="store_true")
    with_cities(sub)
    return parser


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    args = _parser().parse_args(argv)
    spark = spark or build_session(f"skylog {args.job}")
    try:
        return args.run(spark, args)
    finally:
        drop_scratch(spark)


if __name__ == "__main__":
    sys.exit(main())
