"""Mixing sources to target weights by systematic sampling.

Within a source every document has the same expected number of copies, its
source's target over its source's size. The copies are laid end to end on a
line, one random offset is added, and a document is emitted once for every whole
number its stretch of the line crosses. Documents stand on the line by size, so
that the mix has long and short ones in the source's own proportion and its
words come out near the target.

The place of a document on the line is a prefix count over its source. It is
taken in two steps, so that a source with a third of all rows is no single
group: counts per cell (size class and a salt of the id) are small and get
their starts by a window per source; the rows then only count within their cell.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skylog.llm.common import attach, free_name, materialise, null_safe_join

# Weights by place of the source in code point order, null last, repeating.
WEIGHTS = (5, 2, 1)
# A source's target stops at this many times its size.
MOST = 3
# Size classes per doubling are two to the power of this. With 16 salts a source has some thousand cells, however long it is.
CLASS_BITS = 4


def words(text: Column) -> Column:
    """Number of runs of characters other than the space and tab to carriage return; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def unit_hash(key: Column) -> Column:
    """A number from 0 to under 1 that the key fixes."""
    return F.conv(F.substring(F.md5(key), 1, 8), 16, 10).cast("long") / F.lit(4294967296.0)


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """From ``source, source_size`` (a line per source) the ``target`` words of each.

    Weights share the whole size out; a share above ``most`` times its source's
    size stops there, and what is over goes to the others by weight. Sources
    stop in the order of ``most * size / weight``, so one pass over that order
    finds them all: each is held against the level the remaining ones would get.
    The windows run over one line per source, no documents.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    place = (F.row_number().over(by_name) - 1) % len(weights)
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), place + 1)
    sources = sizes.withColumn("weight", weight).withColumn("limit", (F.col("source_size") * most).cast("double"))
    everything = Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    fill = Window.orderBy(F.col("limit") / F.col("weight"), F.col("source").asc_nulls_last())
    before = fill.rowsBetween(Window.unboundedPreceding, -1)
    left = F.sum(F.col("source_size").cast("double")).over(everything) - F.coalesce(F.sum("limit").over(before), F.lit(0.0))
    weighing = F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    levelled = sources.withColumn("level", left / weighing).withColumn("full", F.col("weight") * F.col("level") > F.col("limit"))
    level = F.max(F.when(~F.col("full"), F.col("level"))).over(everything)
    target = F.when(F.col("full"), F.col("limit")).otherwise(F.least(F.col("weight") * level, F.col("limit")))
    return levelled.withColumn("target", target).select("source", "source_size", "weight", "target")


def size_class(size: Column) -> Column:
    """Classes that grow with the size, from the digits of the number alone.

    The highest power of two and the next bits below it: no logarithm whose last
    digit could differ from one machine to the next.
    """
    bits = F.length(F.bin(size))
    top = F.greatest(bits - F.lit(CLASS_BITS + 1), F.lit(0))
    return (bits * F.lit(2 << CLASS_BITS) + F.call_function("shiftright", size.cast("long"), top)).cast("int")


def copies(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", source_column: str = "source", seed: str = "mix", weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """One line per row: ``doc_id, source, size, source_size, target, copies``.

    ``copies`` is 0 to ``most``. The same table and seed give the same copies,
    however the rows are spread. Null texts have size 0; null sources are one
    source; rows with a null id share a salt. Rows that repeat id, source and
    size may trade places, which changes nothing. Sources without words have
    target 0 and no copies. An empty table gives no lines.
    """
    rows = docs.select(
        F.col(id_column).alias("doc_id"), F.col(source_column).cast("string").alias("source"), words(F.col(text_column)).alias("size")
    )
    rows = rows.withColumns(
        {"class": size_class(F.col("size")), "salt": F.substring(F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 1, 1)}
    )
    rows = materialise(rows, "sizes")
    cells = rows.groupBy("source", "class", "salt").agg(F.count(F.lit(1)).alias("cell_rows"), F.sum("size").alias("cell_size"))
    cells = materialise(cells, "cells")

    sizes = cells.groupBy("source").agg(F.sum("cell_size").alias("source_size"))
    targets = source_targets(sizes, weights, most)
    line = Window.partitionBy("source").orderBy("class", "salt")
    starts = cells.withColumn("start", F.sum("cell_rows").over(line) - F.col("cell_rows"))
    starts = null_safe_join(starts, targets, ["source"]).select("source", "class", "salt", "start", "source_size", "target")

    within = Window.partitionBy("source", "class", "salt").orderBy("size", "doc_id")
    placed = rows.withColumn("nth", F.row_number().over(within).cast("long"))
    placed = null_safe_join(placed, starts, ["source", "class", "salt"]).withColumn("place", F.col("start") + F.col("nth"))
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    offset = unit_hash(F.concat(F.lit(seed), F.lit(":"), F.coalesce(F.concat(F.lit("="), "source"), F.lit(""))))
    crossed = F.floor(F.col("place") * rate + offset) - F.floor((F.col("place") - 1) * rate + offset)
    return placed.select(
        "doc_id", "source", "size", "source_size", "target",
        F.least(crossed, F.lit(most).cast("long")).alias("copies"),
    )


def mix(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", source_column: str = "source", seed: str = "mix") -> DataFrame:
    """The mixed rows with all their columns, whatever their names, each as often as it is taken."""
    key, source, size, times, copy = (free_name(f"_mix_{n}", docs) for n in ("id", "source", "size", "copies", "copy"))
    lines = copies(docs, id_column, text_column, source_column, seed).select(
        F.col("doc_id").alias(key), F.col("source").alias(source), F.col("size").alias(size), F.col("copies").alias(times)
    )
    keyed = docs.withColumns({key: F.col(id_column), source: F.col(source_column).cast("string"), size: words(F.col(text_column))})
    taken = attach(keyed, lines, [key, source, size]).where(F.col(times) > 0)
    each = F.explode(F.sequence(F.lit(1).cast("long"), F.col(times))).alias(copy)
    return taken.select(*docs.columns, each).drop(copy)
