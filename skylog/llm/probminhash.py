"""Near duplicates by ProbMinHash.

Every distinct shingle of a document, weighted by how often it occurs, sends out
arrivals of a Poisson process whose rate is its weight; each arrival falls into
one component of the signature, and the earliest in a component names the
shingle that component holds. Two documents agree in a component with a
probability equal to their probability Jaccard similarity. A shingle stops as
soon as its next arrival is later than the latest component, which leaves little
more than one arrival for most.

Bands of the signature give buckets. A bucket is not turned into all its pairs:
each member is held against one of them, the one that shares most with others (of
edited copies that is the text they were made from, if it is there), and verified
links make components; then only members of different components that share a bucket are
compared, by signature and then by shingles, within a task that sends out no more
than the links that join something.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skylog.llm.common import arrow_rows, free_name, importable, materialise
from skylog.llm.components import block_pairs, components
from skylog.llm.shingles import mix, prepared, probability_jaccard, weighted_shingles, words_key

THRESHOLD = 0.8
SIZE = 256
# 42 bands of 6: a pair at 0.8 shares no bucket with a probability of 3e-6, one at 0.3 shares one with 0.03.
ROWS = 6
# Signature agreement below which a pair is not verified: eight standard deviations under the threshold.
MAYBE = 0.6
# Members of a group that are compared at once; larger groups go block against block.
BLOCK = 512

_U = np.uint64
_GOLD = 0x9E3779B97F4A7C15
_SBOX = np.random.default_rng(20).permutation(SIZE).astype(np.uint8)


def signatures(owner: np.ndarray, shingle: np.ndarray, weight: np.ndarray, texts: int) -> np.ndarray:
    """Signatures of all texts of a block, ``texts`` x ``SIZE``.

    Arrivals of a shingle visit every component once, in an order that its hash
    fixes; the i-th comes after an exponential wait at the rate of the
    components not yet visited, so the time of the first arrival in a given
    component is exponential with the shingle's weight.
    """
    earliest = np.full(texts * SIZE, np.inf)
    holder = np.zeros(texts * SIZE, _U)
    time = np.zeros(len(owner))
    order = mix(shingle ^ _U(0xD1B54A32D192ED03))
    step, start, turn = (order & _U(255)) | _U(1), (order >> _U(8)) & _U(255), (order >> _U(16)) & _U(255)
    for i in range(SIZE):
        u = (mix(shingle + _U((i + 1) * _GOLD % 2**64)) >> _U(11)).astype(np.float64) * 2.0**-53
        time = time - np.log1p(-u) * SIZE / ((SIZE - i) * weight)
        component = _SBOX[_SBOX[((step * _U(i) + start) & _U(255))] ^ turn.astype(np.uint8)]
        place = owner * SIZE + component
        np.minimum.at(earliest, place, time)
        first = time == earliest[place]
        holder[place[first]] = shingle[first]
        going = time < earliest.reshape(texts, SIZE).max(axis=1)[owner]
        if not going.any():
            break
        owner, shingle, weight, time = owner[going], shingle[going], weight[going], time[going]
        step, start, turn = step[going], start[going], turn[going]
    return holder.reshape(texts, SIZE)


def _band_keys(signature: np.ndarray) -> np.ndarray:
    bands = SIZE // ROWS
    parts = signature[:, : bands * ROWS].reshape(len(signature), bands, ROWS)
    key = np.broadcast_to(np.arange(1, bands + 1, dtype=_U) * _U(_GOLD), parts.shape[:2]).copy()
    for k in range(ROWS):
        key = mix(key + parts[:, :, k])
    return key.view(np.int64)


def sketch(docs: DataFrame) -> DataFrame:
    """From ``doc_id, text``: ``doc_id, words`` (key of the word sequence), ``bands``, ``signature`` (a byte per component).

    A text without words has neither bands nor signature.
    """

    def work(block: dict[str, list]) -> dict[str, list]:
        texts = [prepared(t) for t in block["text"]]
        owner, shingle, weight = weighted_shingles(texts)
        full = signatures(owner, shingle, weight, len(texts))
        present = np.bincount(owner, minlength=len(texts)) > 0
        keys, small = _band_keys(full), full.astype(np.uint8)
        return {
            "doc_id": block["doc_id"],
            "words": [words_key(t) for t in texts],
            "bands": [keys[i].tolist() if there else None for i, there in enumerate(present)],
            "signature": [small[i].tobytes() if there else None for i, there in enumerate(present)],
        }

    return arrow_rows(docs, work, "doc_id long, words binary, bands array<long>, signature binary", rows=512)


def verify(pairs: DataFrame, texts: DataFrame, threshold: float) -> DataFrame:
    """The pairs ``a, b`` whose texts have a probability Jaccard of at least ``threshold``.

    Texts come by two shuffle joins on the id, the same exchange of texts in
    both; a document in many pairs is split by adaptive execution.
    """
    left = texts.select(F.col("doc_id").alias("a"), F.col("text").alias("text_a"))
    right = texts.select(F.col("doc_id").alias("b"), F.col("text").alias("text_b"))

    def work(block: dict[str, list]) -> dict[str, list]:
        whole = [prepared(t) for pair in zip(block["text_a"], block["text_b"]) for t in pair]
        owner, shingle, weight = weighted_shingles(whole)
        at = np.searchsorted(owner, np.arange(len(whole) + 1))
        sets = [(shingle[i:j], weight[i:j]) for i, j in zip(at, at[1:])]
        good = [i for i in range(len(block["a"])) if probability_jaccard(sets[2 * i], sets[2 * i + 1]) >= threshold - 1e-12]
        return {"a": [block["a"][i] for i in good], "b": [block["b"][i] for i in good]}

    return arrow_rows(pairs.join(left, "a").join(right, "b").select("a", "b", "text_a", "text_b"), work, "a long, b long").distinct()


def _sharing(signature: np.ndarray, meet) -> np.ndarray:
    """Pairs ``a < b`` of rows that agree in a whole band and that ``meet`` lets through, each once."""
    found = []
    packed = np.zeros((len(signature), 8), np.uint8)
    for at in range(0, SIZE // ROWS * ROWS, ROWS):
        packed[:, :ROWS] = signature[:, at : at + ROWS]
        key = packed.view(_U).ravel()
        order = np.argsort(key, kind="stable")
        sorted_key = key[order]
        for k in range(1, len(key)):
            same = np.flatnonzero(sorted_key[k:] == sorted_key[:-k])
            if not len(same):
                break
            a, b = order[same], order[same + k]
            good = meet(a, b)
            found.append(np.minimum(a, b)[good] * len(key) + np.maximum(a, b)[good])
    return np.unique(np.concatenate(found)) if found else np.empty(0, np.int64)


def _group_links(group: pa.Table, threshold: float) -> list[tuple[int, int]]:
    """Links that join components within one group; a pair they have joined already is not looked at again."""
    side, ids, component = (group[c].to_numpy() for c in ("side", "doc_id", "component"))
    whole = group["i"][0] == group["j"][0]
    signature = np.frombuffer(b"".join(group["signature"].to_pylist()), np.uint8).reshape(-1, SIZE)
    pairs = _sharing(signature, lambda a, b: (component[a] != component[b]) & (True if whole else side[a] != side[b]))
    a, b = pairs // len(ids), pairs % len(ids)
    agree = np.concatenate([np.empty(0), *[(signature[x] == signature[y]).mean(axis=1) for x, y in zip(np.array_split(a, len(a) // 65536 + 1), np.array_split(b, len(b) // 65536 + 1))]])
    likely = np.flatnonzero(agree >= MAYBE)
    likely = likely[np.argsort(-agree[likely], kind="stable")]
    if not len(likely):
        return []
    needed = np.unique(np.concatenate([a[likely], b[likely]]))
    owner, shingle, weight = weighted_shingles([prepared(t) for t in group["text"].take(needed).to_pylist()])
    at = np.searchsorted(owner, np.arange(len(needed) + 1))
    sets = {int(n): (shingle[x:y], weight[x:y]) for n, x, y in zip(needed, at, at[1:])}
    low: dict[int, int] = {}

    def root(c: int) -> int:
        while (up := low.get(c, c)) != c:
            c = up
        return c

    links = []
    for x, y in zip(a[likely].tolist(), b[likely].tolist()):
        left, right = root(int(component[x])), root(int(component[y]))
        if left != right and probability_jaccard(sets[x], sets[y]) >= threshold - 1e-12:
            low[max(left, right)] = min(left, right)
            links.append((int(ids[x]), int(ids[y])))
    return links


def _open_links(rows: DataFrame, threshold: float) -> DataFrame:
    """Verified links ``a, b`` between components that meet in a group (``lead, i, j``).

    Pairs stay within the task: those that share a band and whose signatures
    may be similar are verified there, and only links that join something come
    out. Groups come sorted, many to a batch; each is at most two blocks.
    """
    names = ["lead", "i", "j"]

    def work(batches):
        rest: pa.Table | None = None
        schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

        def done(table: pa.Table):
            key = [table[c].to_numpy() for c in names]
            starts = np.flatnonzero(np.append(True, np.logical_or.reduce([c[1:] != c[:-1] for c in key])))
            for at, end in zip(starts, np.append(starts[1:], table.num_rows)):
                if end - at > 1 and (links := _group_links(table.slice(at, end - at).combine_chunks(), threshold)):
                    yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in links]), pa.array([y for _, y in links])], schema=schema)

        for batch in batches:
            table = pa.Table.from_batches([batch])
            table = pa.concat_tables([rest, table]) if rest is not None else table
            last = np.logical_and.reduce([(c := table[n].to_numpy()) == c[-1] for n in names])
            cut = table.num_rows - int(last.sum())  # the last group may go on in the next batch
            if cut:
                yield from done(table.slice(0, cut))
            rest = table.slice(cut)
        if rest is not None and rest.num_rows:
            yield from done(rest)

    importable(rows.sparkSession)
    dealt = rows.repartition(*names).sortWithinPartitions(*names)
    return dealt.select(*names, "side", "doc_id", "component", "signature", "text").mapInArrow(work, "a long, b long").distinct()


def near_duplicates(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """One line per row: ``doc_id, class_id, cluster_id, kept``.

    Documents are alike when the probability Jaccard of their 5-word shingles,
    weighted by how often they occur, is at least ``threshold``. ``class_id`` is
    the smallest id with the same words in the same order, ``cluster_id`` the
    smallest that links of alike documents reach; the row with that id stays.
    Texts without words (null, empty, blank) are alike to none. A row with a
    null id stays alone, its ids null. Rows that share an id are one document:
    they stay or go together. Only the two columns are read. An empty table
    gives no lines.
    """
    given = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).cast("string").alias("text"))
    sketches = materialise(sketch(given), "sketches")
    worded = sketches.where("doc_id IS NOT NULL AND bands IS NOT NULL")

    # Same words: one class, and one signature for it. A class with a third of all rows shrinks before the shuffle.
    classes = worded.groupBy("words").agg(F.min("doc_id").alias("class_id"))
    members = materialise(worded.join(classes, "words").select("doc_id", "class_id").distinct(), "classes")
    heads = members.where("doc_id = class_id").select("doc_id")
    signed = worded.join(heads, "doc_id", "left_semi").select("doc_id", "bands", "signature")

    banded = signed.select("doc_id", F.explode("bands").alias("bucket"))
    shared = banded.groupBy("bucket").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    hits = materialise(banded.join(shared, "bucket"), "buckets")
    standing = hits.groupBy("doc_id").agg(F.sum("size").alias("standing"))
    texts = materialise(given.join(standing, "doc_id", "left_semi"), "texts")

    placed = hits.join(standing, "doc_id").select("bucket", "doc_id", F.struct("standing", (-F.col("doc_id")).alias("minus")).alias("place"))
    lead = placed.groupBy("bucket").agg((-F.max("place")["minus"]).alias("lead"))
    stars = hits.join(lead, "bucket").where("doc_id != lead")
    stars = stars.select(F.greatest("doc_id", "lead").alias("a"), F.least("doc_id", "lead").alias("b")).distinct()
    stars = materialise(stars, "stars")
    links = materialise(verify(stars, texts, threshold), "verified")
    found = components(links)

    # Two members of a bucket are both in the group of its lead, and a document is in few groups.
    groups = hits.join(lead, "bucket").select("lead", "doc_id").distinct()
    joined = groups.join(found, groups["doc_id"] == found["node"], "left").select(
        "lead", "doc_id", F.coalesce("component", "doc_id").alias("component")
    )
    joined = materialise(joined, "groups")
    still_open = joined.groupBy("lead").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low != high")
    open_rows = joined.join(still_open.select("lead"), "lead", "left_semi")
    content = texts.join(worded.select("doc_id", "signature"), "doc_id")
    more = _open_links(block_pairs(open_rows, ["lead"], "doc_id", BLOCK).join(content, "doc_id"), threshold)
    clusters = components(links.unionByName(more))

    lines = members.join(clusters, members["class_id"] == clusters["node"], "left").select(
        "doc_id", "class_id", F.coalesce("component", "class_id").alias("cluster_id")
    )
    # Rows that share an id but not their words belong to whatever either of them belongs to: the smallest of both.
    lines = lines.groupBy("doc_id").agg(F.min("class_id").alias("class_id"), F.min("cluster_id").alias("cluster_id"))
    ids = sketches.select(F.col("doc_id").alias("id"))
    joined = ids.join(lines, ids["id"] == lines["doc_id"], "left")
    return joined.select(
        F.col("id").alias("doc_id"),
        F.coalesce("class_id", "id").alias("class_id"),
        F.coalesce("cluster_id", "id").alias("cluster_id"),
        F.coalesce(F.col("id") == F.coalesce("cluster_id", "id"), F.lit(True)).alias("kept"),
    )


def one_of_each(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The rows that stay, with all their columns, whatever their names."""
    name = free_name("_gone", docs)
    gone = near_duplicates(docs, id_column, text_column, threshold).where("NOT kept").select(F.col("doc_id").alias(name)).distinct()
    return docs.join(gone, docs[id_column] == gone[name], "left_anti")
