"""Session settings and the shared scratch folder."""

from __future__ import annotations

import os
import uuid

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

# Tables written on the way by this process, for ``drop_scratch``.
_written: list[str] = []


def build_session(app: str = "skylog", master: str | None = None, conf: dict[str, str] | None = None) -> SparkSession:
    """A session with the settings the jobs expect.

    Adaptive execution does the sizing: it coalesces small shuffle partitions,
    splits skewed join and rebalance partitions, and turns a join into a
    broadcast only after it has measured the side at run time. Call sites of
    columns are not recorded, which takes longer than planning most queries.
    """
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
        "spark.sql.timestampType": "TIMESTAMP_NTZ",
        "spark.ui.enabled": "false",
        "spark.python.sql.dataFrameDebugging.enabled": "false",
        **(conf or {}),
    }
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new path under the folder named in ``spark.checkpoint.dir``, which all executors share.

    Where it is unset, a local session takes its warehouse; on a cluster that may
    be a folder of one machine, and is refused. ``drop_scratch`` deletes what was
    written there.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = os.path.join(spark.conf.get("spark.sql.warehouse.dir"), "_scratch")
    path = os.path.join(root, f"{label}-{uuid.uuid4().hex}")
    _written.append(path)
    return path


def drop_scratch(spark: SparkSession) -> None:
    """Delete the tables this process wrote on the way; frames that read them cannot be used after that."""
    while _written:
        _delete(spark, _written.pop())


def discard(spark: SparkSession, path: str) -> None:
    """Delete one scratch table, and what is written there alone."""
    _written.remove(path)
    _delete(spark, path)


def _delete(spark: SparkSession, path: str) -> None:
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)


def small_frame(spark: SparkSession, rows: list[tuple], schema: T.StructType | str) -> DataFrame:
    """A handful of driver rows as a frame whose size the optimizer knows.

    Rows handed over as Arrow become a local relation; a Python list would be
    an RDD of unknown size, never broadcast.
    """
    struct = T._parse_datatype_string(schema) if isinstance(schema, str) else schema
    columns = list(zip(*rows)) if rows else [[] for _ in struct]
    table = pa.table(
        [pa.array(list(c), to_arrow_type(f.dataType)) for c, f in zip(columns, struct)], names=struct.names
    )
    return spark.createDataFrame(table, schema=struct)


def materialise(df: DataFrame, label: str) -> DataFrame:
    """Write a frame to the shared folder once and read it back.

    Cuts the lineage at a point several branches of a plan share, so that the
    work above it is done once and survives the loss of an executor.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
