"""Exact duplicates with a split for heavy hitters.

A digest that a third of all rows share would land in one task of an ordinary
shuffle. Misra-Gries counters find the candidates for such digests, an exact
count confirms them, and the confirmed ones - a bounded table - are broadcast,
so that their rows are decided where they are read and never shuffled. All other
digests are below the bound and shuffle as usual.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skylog.llm.common import attach, free_name, lower_ascii, materialise

# Counters per sketch. A digest with more than 3.5 / COUNTERS of all rows is certain to be among the candidates.
COUNTERS = 1024
# Candidates taken from the sketch, which also bounds the broadcast.
WINNERS = 512
# Sketches are merged in this many groups before the last merge.
MERGES = 64


def text_digest(text: Column) -> Column:
    """SHA-256 of the text with A-Z lower-cased; null counts as empty."""
    return F.unhex(F.sha2(F.coalesce(lower_ascii(text), F.lit("")), 256))


def frequent_digests(rows: DataFrame, counters: int = COUNTERS, winners: int = WINNERS) -> DataFrame:
    """Digests that may be frequent, by 64-bit hash: ``hash``.

    ``approx_top_k`` is the mergeable form of Misra-Gries (counters that are all
    lowered together when they run out). Every task sends one sketch; sketches
    meet in ``MERGES`` groups, then once more.
    """
    by_task = rows.groupBy(F.pmod(F.spark_partition_id(), F.lit(MERGES)).alias("task")).agg(
        F.expr(f"approx_top_k_accumulate(xxhash64(digest), {counters})").alias("sketch")
    )
    # Grouped by a constant, not global: a partition without sketches then adds nothing, where a global
    # merge would start from an empty sketch of no type.
    merged = by_task.groupBy(F.lit(0).alias("all")).agg(F.expr(f"approx_top_k_combine(sketch, {counters})").alias("sketch"))
    top = merged.select(F.expr(f"explode(approx_top_k_estimate(sketch, {winners}))").alias("top"))
    return top.select(F.col("top.item").alias("hash"), F.col("top.count").alias("estimate"))


def _group(rows: DataFrame) -> DataFrame:
    """Exact size and the row that stays, per digest; partial aggregation does most of it before the shuffle."""
    return rows.groupBy("digest").agg(
        F.count(F.lit(1)).alias("group_size"), F.max(F.struct("doc_id", "row")).alias("keep")
    )


def exact_dedup(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", counters: int = COUNTERS, winners: int = WINNERS) -> DataFrame:
    """One line per row: ``doc_id, keep_id, group_size, kept, text_sha256``.

    Texts are equal when identical after lower-casing A-Z; null counts as empty.
    Of equal texts the row with the largest id stays, null ids last; of rows that
    repeat an id and a text exactly one has ``kept``. Other columns are not read,
    whatever their names. An empty table gives no lines.
    """
    rows = docs.select(F.col(id_column).alias("doc_id"), text_digest(F.col(text_column)).alias("digest"))
    rows = materialise(rows.withColumn("row", F.monotonically_increasing_id()), "digests")

    candidates = frequent_digests(rows, counters, winners)
    hashed = rows.withColumn("hash", F.xxhash64("digest"))
    maybe = hashed.join(F.broadcast(candidates.select("hash")), "hash", "left_semi")  # at most `winners` lines
    # Confirmed by an exact count of the full digest: a candidate seen once is no heavy hitter.
    heavy = materialise(_group(maybe.select(*rows.columns)).where("group_size > 1"), "heavy")

    won = rows.join(F.broadcast(heavy), "digest")  # map side, at most `winners` lines
    rest = rows.join(F.broadcast(heavy.select("digest")), "digest", "left_anti")
    group = Window.partitionBy("digest")
    rest = rest.select(
        "digest", "doc_id", "row",
        F.count(F.lit(1)).over(group).alias("group_size"),
        F.max(F.struct("doc_id", "row")).over(group).alias("keep"),
    )
    return won.unionByName(rest).select(
        "doc_id",
        F.col("keep.doc_id").alias("keep_id"),
        "group_size",
        (F.col("row") == F.col("keep.row")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def drop_duplicates(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The rows that stay, with all their columns, whatever their names; see ``exact_dedup``."""
    key, digest, stays = (free_name(n, docs) for n in ("_dedup_id", "_dedup_digest", "_dedup_kept"))
    lines = exact_dedup(docs, id_column, text_column).select(
        F.col("doc_id").alias(key), F.unhex("text_sha256").alias(digest), F.col("kept").alias(stays)
    )
    keyed = docs.withColumns({key: F.col(id_column), digest: text_digest(F.col(text_column))})
    return attach(keyed, lines, [key, digest]).where(F.col(stays)).select(*docs.columns)
