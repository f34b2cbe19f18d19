"""Connected components and block-wise work on groups of any size."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skylog.llm.common import materialise


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first())


def components(links: DataFrame) -> DataFrame:
    """From links ``a, b`` a line per linked node: ``node, component`` (the smallest node it reaches).

    Alternating large-star and small-star steps: every node points at ever
    smaller neighbours until all of a component point at its smallest. Each step
    is written to the shared folder; the driver sees a count and a checksum. The
    steps grow with the logarithm of the longest chain. Links with a null end or
    both ends alike are no links.
    """
    kept = links.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    edges = materialise(kept, "links")
    state = _state(edges)
    while state[0]:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("low")).select(F.col("a").alias("centre"), F.least("a", "low").alias("low"))
        large = both.join(low, both["a"] == low["centre"]).where("b > a").select(F.col("b").alias("a"), F.col("low").alias("b")).distinct()
        root = large.groupBy("a").agg(F.min("b").alias("root")).withColumnRenamed("a", "centre")
        joined = large.join(root, large["a"] == root["centre"])
        small = joined.select("a", F.col("root").alias("b")).unionByName(
            joined.where("b != root").select(F.col("b").alias("a"), F.col("root").alias("b"))
        )
        edges = materialise(small.distinct(), "links")
        before, state = state, _state(edges)
        if before == state:
            break
    roots = edges.select(F.col("b").alias("node")).distinct().select("node", F.col("node").alias("component"))
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots)


def block_pairs(rows: DataFrame, keys: list[str], member: str, block: int) -> DataFrame:
    """Cut groups into blocks and put every two blocks of a group together.

    Adds ``i, j`` (blocks, i <= j) and ``side`` (the row's own block). Rows of
    one ``(keys, i, j)`` are at most about two blocks; each pair of rows of a
    group meets in exactly one of them: with ``i = j`` all rows meet, otherwise
    those of different sides. A group of one block is not repeated.
    """
    sizes = rows.groupBy(*keys).agg(F.ceil(F.count(F.lit(1)) / F.lit(block)).cast("int").alias("blocks"))
    cut = rows.join(sizes, keys).withColumn("side", F.pmod(F.xxhash64(member), F.col("blocks")).cast("int"))
    other = cut.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    return other.withColumns({"i": F.least("side", "other"), "j": F.greatest("side", "other")}).drop("blocks", "other")
