"""The test tables read as observations.

``events`` has one row per event type and time, and stands for hourly
observations: the type is the city, the value the index, and the number ``k``
in ``props`` gives the other measures. ``lineitem`` stands for observations over
several years.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from itertools import groupby

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from skylog.functions.text import slug
from skylog.functions.time import with_calendar
from skylog.schemas import FACT_COLUMNS

# Rows per generated payload document. Event ids are unique and consecutive, so
# that a document never holds more, however many events a type has.
PAYLOAD_ROWS = 1000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _measures() -> dict[str, Column]:
    k, user = F.col("k"), F.col("user_id")
    return {
        "temperature_2m": k + F.lit(10.0),
        "relative_humidity_2m": k.cast("double"),
        "precipitation": F.when(k % 5 == 0, k / F.lit(10.0)).otherwise(F.lit(0.0)),
        "wind_speed_10m": k / F.lit(4.0),
        "surface_pressure": k + F.lit(950.0),
        "cloud_cover": F.lit(100.0) - k,
        "weather_code": k,
        "pm2_5": k.cast("double"),
        "pm10": (k + user).cast("double"),
        "carbon_monoxide": user * F.lit(2.0),
        "nitrogen_dioxide": k / F.lit(2.0),
        "sulphur_dioxide": k / F.lit(8.0),
        "ozone": user.cast("double"),
        "us_aqi": F.col("value"),
    }


def raw_observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with all measures, before the calendar; keeps ``event_id`` and ``k``."""
    keyed = table(spark, sf_dir, "events").withColumn("k", F.get_json_object("props", "$.k").cast("int"))
    return keyed.select(
        "event_id",
        "k",
        F.col("event_type").alias("city"),
        F.col("ts").alias("timestamp"),
        *[expr.alias(name) for name, expr in _measures().items()],
    )


def observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as the observation fact."""
    return with_calendar(raw_observations(spark, sf_dir)).select(*FACT_COLUMNS)


def yearly_observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as observations of several years."""
    lines = table(spark, sf_dir, "lineitem")
    return lines.select(
        F.col("l_returnflag").alias("city"),
        F.year("l_shipdate").alias("year"),
        F.month("l_shipdate").alias("month"),
        F.col("l_quantity").alias("us_aqi"),
        F.col("l_discount").alias("pm2_5"),
        F.col("l_linenumber").cast("double").alias("pm10"),
        F.col("l_tax").alias("ozone"),
    )


def payloads(rows: DataFrame, measures: tuple[str, ...], spoil: Column | None = None, spoilt: str = "") -> DataFrame:
    """Rows packed into JSON documents of parallel arrays: ``city, chunk, raw``.

    With ``spoil`` the array ``spoilt`` gets what the expression makes of it;
    null leaves the key out.
    """
    chunk = F.floor(F.col("event_id") / F.lit(PAYLOAD_ROWS))
    entry = F.struct(F.col("timestamp").cast("string").alias("time"), *[F.col(m).cast("double").alias(m) for m in measures])
    packed = rows.groupBy("city", chunk.alias("chunk")).agg(F.sort_array(F.collect_list(entry)).alias("entries"))
    arrays = {name: F.col(f"entries.{name}") for name in ("time", *measures)}
    if spoil is not None:
        arrays[spoilt] = spoil
    hourly = F.struct(*[values.alias(name) for name, values in arrays.items()])
    return packed.select("city", "chunk", F.to_json(F.struct(hourly.alias("hourly"))).alias("raw"))


def documents(rows: DataFrame, measures: tuple[str, ...]) -> DataFrame:
    """One document per city of at most ``PAYLOAD_ROWS`` rows: ``city, slug, raw``; a city is a type and a running number."""
    packed = payloads(rows, measures)
    city = F.concat_ws(" ", "city", F.col("chunk").cast("string"))
    return packed.select(city.alias("city"), slug(city).alias("slug"), "raw")


def land(docs: DataFrame, folder: str, name: Column) -> None:
    """Write each document into the folder under its file name, as a source would.

    Every task writes its files itself, a whole one under a hidden name first, so
    that neither a commit nor a rename of the driver goes through them one by one.
    """
    spark = docs.sparkSession
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    path = jvm.org.apache.hadoop.fs.Path(folder)
    files = path.getFileSystem(conf)
    files.mkdirs(path)
    place = files.makeQualified(path).toUri().toString()

    def write(rows: Iterator[Row]) -> None:
        from pyarrow.fs import FileSystem

        target, root = FileSystem.from_uri(place)
        for file_name, same in groupby(rows, key=lambda row: row[0]):
            hidden = f"{root}/.{uuid.uuid4().hex}"
            with target.open_output_stream(hidden, compression=None) as out:
                for row in same:
                    out.write(row[1].encode() + b"\n")
            target.move(hidden, f"{root}/{file_name}")

    named = docs.select(name.alias("name"), "raw")
    named.repartition("name").sortWithinPartitions("name").foreachPartition(write)
