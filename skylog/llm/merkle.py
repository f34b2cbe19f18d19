"""Merkle manifest of a dataset, kept as concatenated-level strings.

A leaf is the digest of a row. The leaves of a group stand in order; every two
consecutive nodes become the digest of their concatenated digests until one is
left, the group's subroot, and the subroots become the root in the same way.

A level of an aligned block of ``BLOCK`` leaves is one string of hex digests, 64
characters each. Substrings of fixed width are hashed to the next level's string,
and the substring beside a node is its sibling. What the blocks come down to are
the nodes of the next pass, so that no task ever holds more than a block.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skylog.llm.common import materialise

HEIGHT = 8
BLOCK = 1 << HEIGHT
HEX = 64

PATH = "array<struct<side:string,sibling:string>>"


def _field(value: Column) -> Column:
    """``-`` for null, else the byte count, a colon and the value."""
    text = value.cast("string")
    return F.when(text.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def row_digest(*values: Column) -> Column:
    """SHA-256 in lower-case hex over the values, each with its length, so that no two rows spell the same."""
    return F.sha2(F.concat(*map(_field, values)), 256)


def document_leaves(docs: DataFrame) -> DataFrame:
    """``lane, doc_id, leaf, altered``: the leaf of every row, and that of the row after tampering.

    Tampering adds 1 to ``n_chars`` where 7 divides the CRC-32 of the decimal
    ``doc_id``; a null ``n_chars`` stays null, and a row without id is left alone.
    ``lane`` stands for the language: ``-`` for null, ``=`` and the name for all
    others, which sorts null first and the rest bytewise.
    """
    doc_id, count = F.col("doc_id").cast("long"), F.col("n_chars").cast("decimal(38,0)")
    chosen = F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 7 == 0, F.lit(False)) & count.isNotNull()
    digest = lambda n: row_digest(doc_id, F.col("source"), F.col("lang"), n, F.col("text"))
    lane = F.when(F.col("lang").isNull(), F.lit("-")).otherwise(F.concat(F.lit("="), F.col("lang").cast("string")))
    leaves = docs.select(lane.alias("lane"), doc_id.alias("doc_id"), digest(count).alias("leaf"), F.when(chosen, digest(count + 1)).alias("altered"))
    return leaves.withColumn("altered", F.coalesce("altered", "leaf"))


def numbered(rows: DataFrame, lane: str, *order: str) -> DataFrame:
    """Rows with ``pos``, their place from 0 within the lane, in the order of the given columns, nulls first.

    Ranges of all rows are sorted side by side and counted per lane, so that a
    lane with a third of all rows is spread like the others. Rows that agree in
    all columns given may stand on either side of a boundary.
    """
    tied = rows.withColumn("_tie", F.monotonically_increasing_id())
    keys = [lane, *order, "_tie"]
    placed = tied.repartitionByRange(*keys).sortWithinPartitions(*keys).drop("_tie")
    placed = materialise(placed.withColumn("_part", F.spark_partition_id()).withColumn("_seq", F.monotonically_increasing_id()), "ordered")
    counts = placed.groupBy(lane, "_part").agg(F.count(F.lit(1)).alias("_rows"), F.min("_seq").alias("_first"))
    earlier = Window.partitionBy(lane).orderBy("_part")  # a line per part of a lane
    starts = counts.select(lane, "_part", (F.sum("_rows").over(earlier) - F.col("_rows") - F.col("_first")).alias("_shift"))
    return placed.join(starts, [lane, "_part"]).withColumn("pos", F.col("_seq") + F.col("_shift")).drop("_part", "_seq", "_shift")


def _above(level: Column) -> Column:
    """The string of the next level: every run of two digests hashed, a last single one too."""
    runs = F.sequence(F.lit(0), ((F.length(level) + (2 * HEX - 1)) / (2 * HEX)).cast("int") - 1)
    return F.array_join(F.transform(runs, lambda i: F.sha2(level.substr(i * (2 * HEX) + 1, F.lit(2 * HEX)).cast("binary"), 256)), "")


def _blocks(nodes: DataFrame) -> DataFrame:
    """Aligned blocks of ``lane, pos, digest, ...``: ``lane, block, members, levels``.

    A block of a lane that has others is folded ``HEIGHT`` times, even if one
    node is left before; the only block of a lane until one node is left.
    """
    extra = [c for c in nodes.columns if c not in ("lane", "pos", "digest")]
    block = (F.col("pos") / BLOCK).cast("long")
    member = F.struct("pos", "digest", *extra)
    grouped = nodes.groupBy("lane", block.alias("block")).agg(F.sort_array(F.collect_list(member)).alias("members"))
    second = nodes.where(F.col("pos") == BLOCK).select("lane", F.lit(0).cast("long").alias("block"), F.lit(True).alias("others"))
    size = F.size("members")
    alone = F.when(size == 1, F.lit(0)).otherwise(F.length(F.bin(size - 1)))
    tall = (F.col("block") > 0) | F.coalesce("others", F.lit(False))
    height = F.when(tall, F.lit(HEIGHT)).otherwise(alone)
    first = F.array(F.array_join(F.transform("members", lambda m: m["digest"]), ""))
    steps = F.when(height > 0, F.sequence(F.lit(1), height)).otherwise(F.array().cast("array<int>"))
    levels = F.aggregate(steps, first, lambda done, _: F.concat(done, F.array(_above(F.element_at(done, -1)))))
    return grouped.join(second, ["lane", "block"], "left").select("lane", "block", "members", levels.alias("levels"))


def _path(place: Column, levels: Column) -> Column:
    """What stands beside a node on every level of its block: ``L`` or ``R`` and the sibling, or ``-`` and nothing."""

    def step(level: Column, i: Column) -> Column:
        here = F.floor(place / F.pow(F.lit(2), i)).cast("int")
        odd = here % 2 == 1
        sibling = level.substr(F.when(odd, here - 1).otherwise(here + 1) * HEX + 1, F.lit(HEX))
        side = F.when(odd, F.lit("L")).when(sibling == "", F.lit("-")).otherwise(F.lit("R"))
        return F.struct(side.alias("side"), sibling.alias("sibling"))

    return F.transform(F.slice(levels, F.lit(1), F.size(levels) - 1), step)


def _root(levels: Column) -> Column:
    return F.element_at(levels, -1)


def _fold_lanes(nodes: DataFrame) -> tuple[list[DataFrame], DataFrame]:
    """Blocks of every pass, bottom first, and ``lane, subroot``; 256 times fewer nodes each pass."""
    passes = []
    while True:
        blocks = materialise(_blocks(nodes), "merkle-blocks")
        passes.append(blocks)
        tops = blocks.select("lane", F.col("block").alias("pos"), _root(F.col("levels")).alias("digest"))
        most = tops.agg(F.max("pos")).first()[0]
        if not most:
            return passes, tops.select("lane", F.col("digest").alias("subroot"))
        nodes = tops


def _members(blocks: DataFrame, above: DataFrame) -> DataFrame:
    """The members of blocks with their paths to the top; ``above`` has the paths of the blocks."""
    rows = blocks.join(above, ["lane", "block"]).withColumn("member", F.explode("members"))
    place = (F.col("member.pos") % BLOCK).cast("int")
    path = F.concat(_path(place, F.col("levels")), F.col("path"))
    kept = [c for c in above.columns if c not in ("lane", "block", "path")]
    return rows.select("lane", "member.*", *kept, path.alias("path"))


def _below(passes: list[DataFrame], above: DataFrame) -> DataFrame:
    """The members of the first pass, with the paths that lead through the blocks of all passes."""
    for blocks in reversed(passes[1:]):
        above = _members(blocks, above).drop("digest").withColumnRenamed("pos", "block")
    return _members(passes[0], above)


def proofs(nodes: DataFrame) -> DataFrame:
    """``lane, pos, digest, ...`` with ``subroot``, ``root`` and ``path`` (siblings from the leaf to the root)."""
    passes, subroots = _fold_lanes(nodes)
    ranked = numbered(subroots.select(F.lit("").alias("all"), F.col("lane").alias("name"), F.col("subroot").alias("digest")), "all", "name")
    upper, root = _fold_lanes(ranked.select(F.col("all").alias("lane"), "pos", "digest", "name"))
    above = root.select("lane", F.lit(0).cast("long").alias("block"), F.col("subroot").alias("root"), F.array().cast(PATH).alias("path"))
    above = _below(upper, above)
    above = above.select(F.col("name").alias("lane"), F.lit(0).cast("long").alias("block"), F.col("digest").alias("subroot"), "root", "path")
    return _below(passes, above)


def folded(leaf: Column, path: Column) -> Column:
    """The root that a leaf and the siblings on its path lead to."""

    def step(node: Column, beside: Column) -> Column:
        left = F.concat(beside["sibling"], node)
        both = F.when(beside["side"] == "L", left).otherwise(F.concat(node, beside["sibling"]))
        return F.sha2(both.cast("binary"), 256)

    return F.aggregate(path, leaf, step)


def manifest(docs: DataFrame) -> DataFrame:
    """``doc_id, leaf, subroot, root, proof_sha256, folded_root, verified`` per row of ``documents``.

    Rows of a language stand by ``doc_id``, null first, and rows that repeat one
    by their leaf; equal rows have equal leaves and a place each. Null and empty
    texts differ (``-`` and ``0:``). Columns beside the five of the leaf do not
    matter. An empty table has no root and no rows.
    """
    leaves = numbered(document_leaves(docs), "lane", "doc_id", "leaf")
    rows = proofs(leaves.select("lane", "pos", F.col("leaf").alias("digest"), "doc_id", "altered"))
    siblings = F.array_join(F.transform("path", lambda p: p["sibling"]), "")
    rows = rows.withColumn("folded_root", folded(F.col("altered"), F.col("path")))
    return rows.select(
        "doc_id", F.col("digest").alias("leaf"), "subroot", "root", F.sha2(siblings.cast("binary"), 256).alias("proof_sha256"),
        "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"),
    )


def oracle_sql() -> str:
    """The manifest in SQL, level by level, with CRC-32 spelt out bit by bit."""
    field = lambda c: f"CASE WHEN {c} IS NULL THEN '-' ELSE strlen({c}::VARCHAR) || ':' || {c}::VARCHAR END"
    digest = lambda n: f"sha256({' || '.join(map(field, ('doc_id', 'source', 'lang', n, 'text')))})"
    crc = """xor(list_reduce(list_transform(range(strlen(doc_id::VARCHAR)), lambda i: ascii(substr(doc_id::VARCHAR, i + 1, 1))::BIGINT),
                lambda c, b: list_reduce(list_transform(range(8), lambda z: 0::BIGINT), lambda s, z: xor(s >> 1, 3988292384 * (s & 1)), xor(c, b)), 4294967295::BIGINT),
             4294967295::BIGINT)"""
    return f"""
        WITH RECURSIVE d AS (
            SELECT row_number() OVER () AS rid, doc_id, lang, {digest('n_chars')} AS leaf,
                   CASE WHEN doc_id IS NOT NULL AND {crc} % 7 = 0 THEN {digest('(n_chars + 1)')} ELSE {digest('n_chars')} END AS altered
            FROM documents),
        l AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY lang) AS n FROM d),
        t AS (SELECT lang, 0 AS lev, pos, n, leaf AS h FROM l
              UNION ALL
              SELECT lang, lev + 1, pos // 2, (n + 1) // 2, sha256(string_agg(h, '' ORDER BY pos)) FROM t WHERE n > 1 GROUP BY lang, lev, pos // 2, n),
        s AS (SELECT lang, h AS subroot, lev AS height, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS pos, count(*) OVER () AS n FROM t WHERE n = 1),
        u AS (SELECT 0 AS lev, pos, n, subroot AS h FROM s
              UNION ALL
              SELECT lev + 1, pos // 2, (n + 1) // 2, sha256(string_agg(h, '' ORDER BY pos)) FROM u WHERE n > 1 GROUP BY lev, pos // 2, n),
        r AS (SELECT h AS root, lev AS height FROM u WHERE n = 1),
        q AS (SELECT l.rid, l.leaf, l.altered, l.doc_id, s.subroot, r.root, l.lang, l.pos, s.pos AS lane, s.height AS low, r.height AS high
              FROM l JOIN s ON l.lang IS NOT DISTINCT FROM s.lang CROSS JOIN r),
        k AS (SELECT *, unnest(range(low + high)) AS k FROM q),
        e AS (SELECT k.rid, k.k, CASE WHEN k.k < k.low THEN k.pos >> k.k ELSE k.lane >> (k.k - k.low) END AS here,
                     CASE WHEN k.k < k.low THEN t.h ELSE u.h END AS sibling
              FROM k LEFT JOIN t ON k.k < k.low AND t.lang IS NOT DISTINCT FROM k.lang AND t.lev = k.k AND t.pos = xor(k.pos >> k.k, 1)
                     LEFT JOIN u ON k.k >= k.low AND u.lev = k.k - k.low AND u.pos = xor(k.lane >> (k.k - k.low), 1)),
        f AS (SELECT rid, 0::BIGINT AS k, altered AS h FROM q
              UNION ALL
              SELECT f.rid, f.k + 1, sha256(CASE WHEN e.here % 2 = 1 THEN e.sibling || f.h ELSE f.h || coalesce(e.sibling, '') END)
              FROM f JOIN e ON e.rid = f.rid AND e.k = f.k)
        SELECT q.doc_id, q.leaf, q.subroot, q.root,
               sha256(coalesce((SELECT string_agg(e.sibling, '' ORDER BY e.k) FROM e WHERE e.rid = q.rid), '')) AS proof_sha256,
               f.h AS folded_root, f.h = q.root AS verified
        FROM q JOIN f ON f.rid = q.rid AND f.k = q.low + q.high
    """
