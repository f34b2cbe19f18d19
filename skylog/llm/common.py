"""Helpers the operators of this package share."""

from __future__ import annotations

import ctypes
import os
from collections.abc import Callable, Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from skylog.session import materialise, scratch_path

__all__ = ["arrow_rows", "attach", "free_name", "give_back", "importable", "lower_ascii", "materialise", "null_safe_join", "scratch_path", "table"]

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def lower_ascii(text: Column) -> Column:
    """Lower-case A-Z and nothing else; ``lower`` does just that where all is ASCII, and faster."""
    plain = F.octet_length(text) == F.char_length(text)
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, UPPER, UPPER.lower()))


def free_name(name: str, *frames: DataFrame) -> str:
    """``name``, with as many underscores behind it as no column of the frames has, whatever its case."""
    taken = {c.lower() for frame in frames for c in frame.columns}
    while name.lower() in taken:
        name += "_"
    return name


def null_safe_join(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Join on keys that may be null; keys come from the left, and so do columns of the same name."""
    spare = [c for c in right.columns if c not in left.columns]
    other = {k: free_name(f"_right_{k}", left, right) for k in keys}
    renamed = right.select(*[F.col(k).alias(other[k]) for k in keys], *([] if how.startswith("left_") else spare))
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(other[k])) for k in keys])
    return left.join(renamed, same, how).drop(*other.values())


def importable(spark: SparkSession) -> SparkSession:
    """Let Python workers that see this folder import the library from it, wherever the driver was started.

    On a cluster whose machines do not see it, hand the library to
    ``spark-submit --py-files``.
    """
    import skylog

    root = os.path.dirname(os.path.dirname(os.path.abspath(skylog.__file__)))
    environment = spark.sparkContext.environment
    known = environment.get("PYTHONPATH", "").split(os.pathsep)
    if root not in known:
        environment["PYTHONPATH"] = os.pathsep.join([p for p in known if p] + [root])
    return spark


def arrow_rows(df: DataFrame, work: Callable[[dict[str, list]], dict[str, list]], schema: str, rows: int = 256) -> DataFrame:
    """Map blocks of at most ``rows`` rows, columns as Python lists, in Arrow.

    Arrow batches are cut down to ``rows`` so that memory follows the texts of a
    block and not the session's batch size; nothing is kept between blocks but
    what ``work`` keeps itself.
    """
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType, _parse_datatype_string

    parsed = _parse_datatype_string(schema)
    assert isinstance(parsed, StructType)
    target = to_arrow_schema(parsed)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, rows):
                part = batch.slice(start, rows)
                made = work({n: part.column(i).to_pylist() for i, n in enumerate(part.schema.names)})
                yield pa.RecordBatch.from_arrays([pa.array(made[f.name], f.type) for f in target], schema=target)
            batch = part = made = None
        give_back()

    importable(df.sparkSession)
    return df.mapInArrow(run, parsed)


def give_back() -> None:
    """Hand memory that holds nothing any more back to the system.

    Python workers go on to the next stage with all they ever took; where several
    stages need much at different places, that adds up.
    """
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc alone has it
    if trim is not None:
        trim(0)


def attach(rows: DataFrame, decisions: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Join decisions to the rows they were made on, one to one, keys null-safe.

    ``decisions`` has one line per row of the same frame (or of a part of it). A
    key that several lines share names rows that differ in nothing the decision
    knows; those are paired in order, so that none is multiplied. Only such
    repeated keys pass the window; all other rows take the plain join. The keys
    and columns of ``decisions`` have names that ``rows`` has no others of.
    """
    n_lines, at = free_name("_lines", rows, decisions), free_name("_place", rows, decisions)
    spare = [c for c in decisions.columns if c not in keys]
    counted = decisions.groupBy(*keys).agg(F.count(F.lit(1)).alias(n_lines), *[F.first(c).alias(c) for c in spare])
    plain = null_safe_join(rows, counted.where(F.col(n_lines) == 1).drop(n_lines), keys, how)

    repeated = counted.where(F.col(n_lines) > 1).select(*keys)
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(*(spare or keys)))
    lines = null_safe_join(decisions, repeated, keys, "left_semi").withColumn(at, place)
    order = [c for c, kind in rows.dtypes if not kind.startswith(("map", "variant"))]
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    several = null_safe_join(rows, repeated, keys, "left_semi").withColumn(at, place)
    paired = null_safe_join(several, lines, [*keys, at]).drop(at)
    return plain.unionByName(paired)
