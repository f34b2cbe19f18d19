"""Near-duplicate vectors by a forest of random-projection trees.

A tree splits the vectors of a label again and again: it projects them on a
random direction and cuts at the median, or clear of a crowd that stands there,
and vectors near the cut go to both sides. Vectors that end in one leaf are
compared. What one tree cuts apart, another keeps together; the forest's links are
united into components.

Large nodes are split on the cluster, a level of several splits at a time, by
medians of a bounded sample of each node; nodes that fit in a task are split
further where they are. A node of vectors so close that no cut parts them is
compared block against block.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from skylog.llm.common import importable, materialise
from skylog.llm.components import block_pairs, components

THRESHOLD = 0.98
TREES = 6
# Vectors within this of a cut go to both sides, but no more than this share of a node's: copies then grow
# with the size to the power 0.08. Of two vectors at cosine 0.98, whose distance is 0.2, a cut in 64
# dimensions parts one pair in fifty or so; all trees part next to none.
SPILL, SHARED = 0.0125, 0.06
# A node of at most this many vectors is split within one task.
NODE = 4096
# A leaf of at most this many is compared as it is.
LEAF = 256
# Vectors of a node whose medians decide the splits of a level, and splits of a level one below the other.
SAMPLE = 1024
DEPTH = 4
# Directions tried for a split that stands clear of crowds.
TURNS = 3
# Vectors compared with each other at once.
BLOCK = 1024


def _direction(name: str, turn: int, size: int) -> np.ndarray:
    """A unit vector that the name of a node fixes."""
    rng = np.random.default_rng([zlib.crc32(name.encode()), turn])
    v = rng.standard_normal(size)
    return v / np.linalg.norm(v)


def _matrix(vectors) -> np.ndarray:
    """Vectors as unit rows, in double precision."""
    x = np.array([np.asarray(v, np.float64) for v in vectors])
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _cut(on: np.ndarray) -> tuple[float, float, float]:
    """Where to cut vectors by their projection, how wide to spill, and what share stands within ``SPILL`` of the cut.

    A cut near the median that few stand near is best. Where all have a crowd,
    the thinnest goes through it, and spills as far as the share allows.
    """
    best = (0.0, 0.0, 2.0)
    for share in (0.5, 0.35, 0.65, 0.2, 0.8):
        cut = float(np.quantile(on, share))
        apart = np.abs(on - cut)
        close = float((apart <= SPILL).mean())
        if close <= SHARED:
            return cut, SPILL, close
        if close < best[2]:
            best = (cut, min(SPILL, float(np.quantile(apart, SHARED))), close)
    return best


def _split(x: np.ndarray, name: str) -> tuple[int, float, float] | None:
    """Of a few directions the first that has a cut clear of crowds, or else the one with the thinnest; None where all stand on one spot."""
    tried = []
    for turn in range(TURNS):
        cut, spill, close = _cut(x @ _direction(name, turn, x.shape[1]))
        tried.append((close, turn, cut, spill))
        if close <= SHARED:
            break
    for _, turn, cut, spill in sorted(tried):
        left, right = _sides(x, name, np.arange(len(x)), turn, cut, spill)
        if max(len(left), len(right)) <= 0.9 * len(x):
            return turn, cut, spill
    return None


def _sides(x: np.ndarray, name: str, rows: np.ndarray, turn: int, cut: float, spill: float) -> tuple[np.ndarray, np.ndarray]:
    on = x[rows] @ _direction(name, turn, x.shape[1])
    return rows[on <= cut + spill], rows[on > cut - spill]


def _cuts(x: np.ndarray, name: str, depth: int) -> tuple[list[int], list[float], list[float]]:
    """Splits of a node, breadth first, as directions, cuts and spills; direction -1 leaves a part as it is."""
    parts, splits = [np.arange(len(x))], []
    for level in range(depth):
        below = []
        for place, part in enumerate(parts):
            own = f"{name}.{level}.{place}"
            split = (len(part) >= 32 and _split(x[part], own)) or (-1, 0.0, 0.0)
            splits.append(split)
            below += _sides(x, own, part, *split) if split[0] >= 0 else (part, part[:0])
        parts = below
    turns, cuts, spills = zip(*splits)
    return list(turns), list(cuts), list(spills)


def _route(x: np.ndarray, name: str, turns: list[int], cuts: list[float], spills: list[float]) -> list[np.ndarray]:
    """The rows that reach each end of the splits."""
    parts, at, level = [np.arange(len(x))], 0, 0
    while at < len(cuts):
        below = []
        for place, part in enumerate(parts):
            split = (turns[at], cuts[at], spills[at])
            at += 1
            below += _sides(x, f"{name}.{level}.{place}", part, *split) if split[0] >= 0 else (part, part[:0])
        parts, level = below, level + 1
    return parts


def _leaves(x: np.ndarray, name: str, rows: np.ndarray) -> Iterator[np.ndarray]:
    """Split further in memory, down to leaves and bunches that have no good cut."""
    waiting = [(name, rows)]
    while waiting:
        name, rows = waiting.pop()
        found = _split(x[rows], name) if len(rows) > LEAF else None
        if found is None:
            yield rows
        else:
            left, right = _sides(x, name, rows, *found)
            waiting += [(f"{name}l", left), (f"{name}r", right)]


def _spanning(x: np.ndarray, meet: np.ndarray | None = None, threshold: float = THRESHOLD) -> tuple[np.ndarray, np.ndarray]:
    """Links that join what is linked, not all of them: every row with the smallest row that links reach.

    ``meet`` gives sides; rows of one side are then not compared.
    """
    low = np.arange(len(x))
    while True:
        before = low.copy()
        for at in range(0, len(x), BLOCK):
            near = x[at : at + BLOCK] @ x.T >= threshold
            if meet is not None:
                near &= meet[at : at + BLOCK, None] != meet[None, :]
                near[np.arange(len(near)), at + np.arange(len(near))] = True
            low[at : at + BLOCK] = np.where(near, low[None, :], len(x)).min(axis=1).clip(max=low[at : at + BLOCK])
        if (low == before).all():
            break
    joined = np.flatnonzero(low != np.arange(len(x)))
    return joined, low[joined]


def _links(node: str, ids: np.ndarray, x: np.ndarray) -> pd.DataFrame:
    """Links that join what is linked in any leaf of a node, at most one per row: leaves share rows, and repeat themselves."""
    low = np.arange(len(x))

    def root(i: int) -> int:
        while low[i] != i:
            low[i] = low[low[i]]
            i = int(low[i])
        return i

    for rows in _leaves(x, node, np.arange(len(x))):
        for i, j in zip(*_spanning(x[rows])):
            a, b = root(int(rows[i])), root(int(rows[j]))
            if a != b:
                low[max(a, b)] = min(a, b)
    joined = np.flatnonzero(low != np.arange(len(x)))
    return pd.DataFrame({"a": ids[joined], "b": ids[[root(int(i)) for i in joined]] if len(joined) else ids[:0]})


def _split_level(rows: DataFrame, large: DataFrame) -> DataFrame:
    """The rows of large nodes, moved to the ends of ``DEPTH`` splits; ``large`` has a line per node."""
    order = Window.partitionBy("node").orderBy(F.xxhash64("id", "node"))
    sample = rows.join(large.select("node"), "node", "left_semi").withColumn("place", F.row_number().over(order))
    sample = sample.where(F.col("place") <= SAMPLE).select("node", "vector")

    def learn(pdf: pd.DataFrame) -> pd.DataFrame:
        name = pdf["node"].iloc[0]
        turns, cuts, spills = _cuts(_matrix(pdf["vector"]), name, DEPTH)
        return pd.DataFrame({"node": [name], "turns": [turns], "cuts": [cuts], "spills": [spills]})

    cuts = sample.groupBy("node").applyInPandas(learn, "node string, turns array<int>, cuts array<double>, spills array<double>")

    def move(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            for name, group in pdf.groupby("node", sort=False):
                ends = _route(_matrix(group["vector"]), name, *[list(group[c].iloc[0]) for c in ("turns", "cuts", "spills")])
                for end, part in enumerate(ends):
                    if len(part):
                        moved = group.iloc[part]
                        yield pd.DataFrame({"node": f"{name}/{end}", "id": moved["id"].to_numpy(), "vector": moved["vector"].to_numpy()})

    return rows.join(cuts, "node").mapInPandas(move, "node string, id long, vector array<double>")


def _forest_links(vectors: DataFrame, trees: int, node_rows: int) -> DataFrame:
    """Links ``a, b`` found in any leaf of any tree. ``vectors``: ``id, root, vector``."""
    tree = F.explode(F.array(*[F.lit(t) for t in range(trees)]))
    rows = vectors.select("root", "id", "vector", tree.alias("tree")).select(
        F.concat_ws("/", F.col("tree").cast("string"), "root").alias("node"), "id", "vector"
    )
    found = []
    parents = None
    while True:
        rows = materialise(rows, "nodes")
        sizes = rows.groupBy("node").agg(F.count(F.lit(1)).alias("size"))
        if parents is None:
            state = sizes.withColumn("stuck", F.lit(False))
        else:
            # A child with over nine tenths of its node's rows, after all its cuts: the node is too dense to split.
            mother = F.regexp_replace("node", "/[0-9]+$", "")
            held = parents.select(F.col("node").alias("mother"), F.col("size").alias("whole"))
            state = sizes.withColumn("mother", mother).join(held, "mother").withColumn("stuck", F.col("size") > F.col("whole") * 0.9)
        state = materialise(state.select("node", "size", "stuck"), "nodes")
        large = state.where((F.col("size") > node_rows) & ~F.col("stuck"))
        dense = state.where((F.col("size") > node_rows) & F.col("stuck"))
        fits = state.where(F.col("size") <= node_rows)
        small = rows.join(fits.select("node"), "node", "left_semi")

        def in_node(pdf: pd.DataFrame) -> pd.DataFrame:
            return _links(pdf["node"].iloc[0], pdf["id"].to_numpy(), _matrix(pdf["vector"]))

        found.append(materialise(small.groupBy("node").applyInPandas(in_node, "a long, b long").distinct(), "links"))
        if dense.limit(1).count():
            paired = block_pairs(rows.join(dense.select("node"), "node", "left_semi"), ["node"], "id", BLOCK).repartition("node", "i", "j")

            def in_pair(pdf: pd.DataFrame) -> pd.DataFrame:
                side = None if pdf["i"].iloc[0] == pdf["j"].iloc[0] else pdf["side"].to_numpy()
                x, ids = _matrix(pdf["vector"]), pdf["id"].to_numpy()
                i, j = _spanning(x, side)
                return pd.DataFrame({"a": ids[i], "b": ids[j]})

            found.append(materialise(paired.groupBy("node", "i", "j").applyInPandas(in_pair, "a long, b long").distinct(), "links"))
        if not large.limit(1).count():
            break
        rows, parents = _split_level(rows.join(large.select("node"), "node", "left_semi"), large), large
    links = found[0]
    for more in found[1:]:
        links = links.unionByName(more)
    return links


def _link_counts(members: DataFrame) -> DataFrame:
    """Exact number of linked vectors per class: ``id, linked``. ``members``: ``component, id, copies, vector``.

    All links are within components, so each is compared with itself, block
    against block. Counts come out, never pairs.
    """
    # The join within deals by component; its blocks must part again.
    paired = block_pairs(members, ["component"], "id", BLOCK).repartition("component", "i", "j")

    def count(pdf: pd.DataFrame) -> pd.DataFrame:
        x, copies, side = _matrix(pdf["vector"]), pdf["copies"].to_numpy(np.float64), pdf["side"].to_numpy()
        apart = pdf["i"].iloc[0] != pdf["j"].iloc[0]
        linked = np.zeros(len(x))
        for at in range(0, len(x), BLOCK):
            near = x[at : at + BLOCK] @ x.T >= THRESHOLD
            near[np.arange(len(near)), at + np.arange(len(near))] = False
            if apart:
                near &= side[at : at + BLOCK, None] != side[None, :]
            linked[at : at + BLOCK] = near @ copies
        return pd.DataFrame({"id": pdf["id"], "linked": linked.astype(np.int64)})

    counted = paired.groupBy("component", "i", "j").applyInPandas(count, "id long, linked long")
    return counted.groupBy("id").agg(F.sum("linked").alias("linked"))


def near_vectors(embeddings: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding", label_column: str = "label", trees: int = TREES, node_rows: int = NODE) -> DataFrame:
    """One line per row: ``vec_id, n_links, component_id, kept``.

    Vectors of one label (and one length) with a cosine of at least 0.98 in
    double precision are linked. Null labels, null ids and vectors that are
    null, empty, zero or hold null or non-finite numbers link with nothing; a
    null id has a null component and is kept. Equal vectors are compared once,
    by the smallest id. Rows that share an id are one vector node: their links
    are those of all of them, and a row that is repeated counts once. Only the
    three columns are read. An empty table gives no lines.
    """
    importable(embeddings.sparkSession)
    given = embeddings.select(
        F.col(id_column).cast("long").alias("id"), F.col(label_column).cast("string").alias("label"),
        F.col(vector_column).cast("array<double>").alias("vector"),
    )
    bad = lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf"))
    sound = F.col("id").isNotNull() & F.col("label").isNotNull() & (F.size("vector") > 0) & ~F.exists("vector", bad)
    sound = sound & F.exists("vector", lambda v: v != 0)
    distinct = given.where(F.coalesce(sound, F.lit(False))).distinct()
    root = F.concat_ws(":", F.size("vector").cast("string"), "label")
    classes = distinct.groupBy(root.alias("root"), "vector").agg(F.min("id").alias("id"), F.count(F.lit(1)).alias("copies"))
    classes = materialise(classes, "vectors")
    # A smallest id that two different vectors share would count both as one; a node of the forest is then either.
    found = components(_forest_links(classes.select("root", "id", "vector"), trees, node_rows))

    grouped = classes.join(found, classes["id"] == found["node"])
    linked = _link_counts(grouped.select("component", "id", "copies", "vector"))
    keyed = distinct.withColumn("root", root).withColumnRenamed("id", "vec_id").withColumnRenamed("vector", "own")
    whole = classes.join(linked, "id", "left").join(found, classes["id"] == found["node"], "left").select(
        F.col("root").alias("class_root"), "vector", "copies", F.coalesce("linked", F.lit(0)).alias("linked"), F.coalesce("component", "id").alias("component")
    )
    lines = keyed.join(whole, (keyed["root"] == whole["class_root"]) & (keyed["own"] == whole["vector"])).groupBy("vec_id").agg(
        F.sum(F.col("linked") + F.col("copies") - 1).alias("n_links"), F.min("component").alias("component_id")
    )
    ids = given.select("id")
    joined = ids.join(lines, ids["id"] == lines["vec_id"], "left")
    return joined.select(
        F.col("id").alias("vec_id"),
        F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"),
        F.coalesce("component_id", "id").alias("component_id"),
        F.coalesce(F.col("id") == F.coalesce("component_id", "id"), F.lit(True)).alias("kept"),
    )
