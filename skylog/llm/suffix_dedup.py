"""Bytes of texts that are covered by long strings which stand elsewhere too, by suffix arrays.

Equal strings must meet, and only few strings of a corpus are equal to another:

* **Windows.** Every start of a ``length``-byte string belongs to the smallest hash
  among the short strings inside it (the rightmost of equal ones). Neighbouring
  starts that share that anchor make one window row, with a key, the anchor's
  hash, and the digest of all its bytes. Equal strings have equal anchors at the
  same place, so that they have the same key.
* **Counting.** Window rows with equal bytes are repeated without further ado. A key
  with one kind of bytes is settled. What is left are keys under which different
  bytes meet, of which one at least is alone.
* **Suffix arrays** by linear grouping (``suffix_groups``) over the bytes of each
  such key: a string stands elsewhere if a neighbour in the array shares as many
  bytes.
* **Crowded keys**, with more kinds of bytes than ``CROWD``, are cut by where strings
  start relative to the anchor, into cells of 64, 8 and 1 starts, each with the
  bytes that all strings of the cell share as its key; after a cut, the steps
  above start again. With cells of one start nothing is left to compare.

Rows hold digests and numbers until bytes have to be compared. Texts move once, to
be gathered by digest, and are bucketed there.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator
from functools import lru_cache, reduce

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skylog.llm.common import arrow_rows, give_back, importable, materialise, scratch_path
from skylog.llm.suffix_groups import common_prefixes, suffix_arrays

LENGTH = 400
# Bytes of an anchor; a longer one is rarer, a shorter one leaves fewer rows.
ANCHOR = 64
# Kinds of bytes under a key that a suffix array takes at once.
CROWD = 32
CELLS = (64, 8, 1)
# Bytes that are hashed, and that suffix arrays are built over, at a time.
PIECE = 1 << 18
# A key with more than one in so many rows is counted apart, so that there are at most that many of them.
SHARE = 1000

_U = np.uint64
_PLACE = _U((1 << 24) - 1)
WINDOWS = "key long, kind1 long, kind2 long, text binary, place long, copies int"


def text_digest(text: Column) -> Column:
    """Which text it is: the first 128 bits of its SHA-256; null counts as empty."""
    return F.unhex(F.sha2(F.coalesce(text.cast("string"), F.lit("")).cast("binary"), 256)).substr(1, 16)


def gathered_texts(docs: DataFrame) -> DataFrame:
    """``text, copies, packed``: every different text once, compressed, bucketed by its digest."""

    def work(block: dict[str, list]) -> dict[str, list]:
        texts = [(t or "").encode() for t in block["body"]]
        pack = zstandard.ZstdCompressor(level=1).compress
        return {"text": [hashlib.sha256(t).digest()[:16] for t in texts], "packed": [pack(t) for t in texts]}

    spark = docs.sparkSession
    packed = arrow_rows(docs.select(F.col("text").cast("string").alias("body")), work, "text binary, packed binary")
    each = packed.groupBy("text").agg(F.count(F.lit(1)).alias("copies"), F.first("packed").alias("packed"))
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    name = f"texts_{uuid.uuid4().hex}"
    each.repartition(buckets, "text").write.bucketBy(buckets, "text").option("path", scratch_path(spark, "texts")).saveAsTable(name)
    return spark.table(name)


@lru_cache(maxsize=1)
def _powers() -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd number and of its inverse, modulo 2 to the 64."""
    base = 0x9E3779B97F4A7C15
    made = []
    for factor in (base, pow(base, -1, 1 << 64)):
        steps = np.full(PIECE + 2 * LENGTH, factor, _U)
        steps[0] = 1
        made.append(np.cumprod(steps, dtype=_U))
    return made[0], made[1]


def _anchors(data: np.ndarray, length: int, anchor: int) -> tuple[np.ndarray, np.ndarray]:
    """Of every start of a ``length``-byte string, where its anchor is; and the hash of every place."""
    up, down = _powers()
    n = len(data)
    sums = np.zeros(n + 1, _U)
    np.cumsum((data.astype(_U) + _U(1)) * up[:n], out=sums[1:])
    m = n - anchor + 1
    hashes = (sums[anchor:] - sums[:m]) * down[:m]
    hashes ^= hashes >> _U(31)
    hashes *= _U(0xBF58476D1CE4E5B9)
    hashes ^= hashes >> _U(29)
    # The place in the low bits makes the rightmost of equal hashes the smallest.
    ranked = (hashes & ~_PLACE) | (_PLACE - np.arange(m, dtype=_U))
    width = length - anchor + 1
    padded = np.concatenate([ranked, np.full(-m % width, ~_U(0))]).reshape(-1, width)
    ahead = np.minimum.accumulate(padded, axis=1).ravel()
    back = np.minimum.accumulate(padded[:, ::-1], axis=1)[:, ::-1].ravel()
    least = np.minimum(back[: m - width + 1], ahead[width - 1 : m])
    return (_PLACE - (least & _PLACE)).astype(np.int64), hashes


def _packed_place(start: int, starts: int, ahead: int) -> int:
    """Where a window row is: its first start, how many starts, and how far its anchor is ahead of the first."""
    return start << 20 | starts << 10 | ahead


def _unpacked_place(place: int) -> tuple[int, int, int]:
    return place >> 20, place >> 10 & 1023, place & 1023


def _number(digest: bytes) -> int:
    return int.from_bytes(digest, "little", signed=True)


def _kind(data: bytes) -> tuple[int, int]:
    digest = hashlib.blake2b(data, digest_size=16).digest()
    return _number(digest[:8]), _number(digest[8:])


def _pieces(texts: list[bytes], length: int) -> Iterator[tuple[bytes, list[tuple[int, int, int, int]]]]:
    """Buffers of about ``PIECE`` bytes: bytes, and per part the text, its place in the buffer, its size, and where in the text it is."""
    buffer, parts, size = [], [], 0
    for i, text in enumerate(texts):
        for at in range(0, max(len(text) - length + 1, 0), PIECE):
            part = text[at : at + PIECE + length - 1]
            if size + len(part) > PIECE + length and parts:
                yield b"".join(buffer), parts
                buffer, parts, size = [], [], 0
            buffer.append(part)
            parts.append((i, size, len(part), at))
            size += len(part)
    if parts:
        yield b"".join(buffer), parts


def windows(texts: DataFrame, length: int = LENGTH) -> DataFrame:
    """The window rows of all texts."""

    def work(block: dict[str, list]) -> dict[str, list]:
        made: dict[str, list] = {c.split()[0]: [] for c in WINDOWS.split(", ")}
        unpack = zstandard.ZstdDecompressor().decompress
        for data, parts in _pieces([unpack(p) for p in block["packed"]], length):
            anchors, hashes = _anchors(np.frombuffer(data, np.uint8), length, ANCHOR)
            hashes = hashes.astype(np.int64)
            for i, begin, size, at in parts:
                own = anchors[begin : begin + size - length + 1]
                first = np.append(0, np.flatnonzero(own[1:] != own[:-1]) + 1)
                last = np.append(first[1:], len(own))
                chosen = own[first]
                kinds = [_kind(data[begin + a : begin + b + length - 1]) for a, b in zip(first.tolist(), last.tolist())]
                made["key"] += hashes[chosen].tolist()
                made["kind1"] += [k for k, _ in kinds]
                made["kind2"] += [k for _, k in kinds]
                made["place"] += ((at + first) << 20 | (last - first) << 10 | (chosen - begin - first)).tolist()
                made["text"] += [block["text"][i]] * len(first)
                made["copies"] += [min(block["copies"][i], 2)] * len(first)
        return made

    return arrow_rows(texts.select("text", "copies", "packed"), work, WINDOWS)


def _heavy(counts: DataFrame, name: Column, total: int) -> list:
    """What holds more than one in ``SHARE`` of all rows, by name; at most that many."""
    least = max(total / SHARE, 4 * CROWD)
    return [r[0] for r in counts.where(F.col("rows") > least).select(name).collect()]


FOUND = ["key", "text", "place", "kinds", "alone", "repeated", "open"]


def _settle(rows: DataFrame) -> DataFrame:
    """What counting finds: rows whose bytes are ``repeated``, and one per kind of bytes of the keys left ``open``.

    Rows meet in windows by key over a single shuffle. Keys with a large share of
    the rows are aggregated instead, and their rows meet by kind of bytes; kinds
    with a large share themselves need no count. Both are lists of bounded length.
    """
    total = rows.count()
    heavy = _heavy(rows.groupBy("key").agg(F.count(F.lit(1)).alias("rows")), F.col("key"), total)
    is_heavy = F.col("key").isin(heavy) if heavy else F.lit(False)
    kind = Window.partitionBy("key", "kind1", "kind2")
    key = Window.partitionBy("key")
    told = rows.where(~is_heavy).repartition("key").select(
        "*", F.sum("copies").over(kind).alias("same"), F.row_number().over(kind.orderBy("text", "place")).alias("nth")
    )
    told = told.select("*", F.sum(F.when(F.col("nth") == 1, 1)).over(key).alias("kinds"), F.min("same").over(key).alias("least"))
    repeated = (F.col("same") >= 2) & (F.col("copies") == 1)
    unsettled = (F.col("nth") == 1) & (F.col("kinds") >= 2) & (F.col("least") == 1)
    found = told.select("key", "text", "place", "kinds", (F.col("same") == 1).alias("alone"), repeated.alias("repeated"), unsettled.alias("open"))
    found = found.where("repeated OR open")

    if heavy:
        crowded = rows.where(is_heavy)
        kinds = crowded.groupBy("key", "kind1", "kind2").agg(
            F.sum("copies").alias("same"), F.count(F.lit(1)).alias("rows"), F.min(F.struct("text", "place")).alias("first")
        )
        kinds = materialise(kinds, "crowded-kinds")
        keys = kinds.groupBy("key").agg(F.count(F.lit(1)).alias("kinds"), F.min("same").alias("least")).where("kinds >= 2 AND least = 1")
        unsettled = kinds.join(F.broadcast(keys), "key")  # no more keys than heavy ones
        found = found.unionByName(unsettled.select("key", "first.text", "first.place", "kinds", (F.col("same") == 1).alias("alone"), F.lit(False).alias("repeated"), F.lit(True).alias("open")))
        # What many rows share is repeated by its number; the rest is counted kind by kind.
        name = F.concat_ws(" ", "key", "kind1", "kind2")
        heavy_kinds = _heavy(kinds, name, total)
        is_heavy = name.isin(heavy_kinds) if heavy_kinds else F.lit(False)
        counted = crowded.where(~is_heavy).select("*", F.sum("copies").over(kind).alias("same"))
        for part in (counted.where(repeated), crowded.where(is_heavy & (F.col("copies") == 1))):
            found = found.unionByName(part.select("key", "text", "place", F.lit(None).cast("long").alias("kinds"), F.lit(False).alias("alone"), F.lit(True).alias("repeated"), F.lit(False).alias("open")))
    return materialise(found.select(*FOUND), "window-kinds")


def _with_texts(rows: DataFrame, texts: DataFrame, extra: list[str]) -> DataFrame:
    """Texts beside the lists of what is wanted of them; texts stay where their buckets are."""
    lists = rows.groupBy("text").agg(F.collect_list(F.struct("key", "place", *extra)).alias("wanted"))
    return texts.select("text", "packed").join(lists, "text")


def _cells(rows: DataFrame, texts: DataFrame, width: int, length: int) -> DataFrame:
    """Window rows of crowded keys cut by the distance of starts to their anchor, in cells of ``width``."""

    def work(block: dict[str, list]) -> dict[str, list]:
        made: dict[str, list] = {c.split()[0]: [] for c in WINDOWS.split(", ")}
        unpack = zstandard.ZstdDecompressor().decompress
        for text, packed, wanted in zip(block["text"], block["packed"], block["wanted"]):
            data = unpack(packed)
            for item in wanted:
                start, starts, ahead = _unpacked_place(item["place"])
                anchor = start + ahead
                for cell in range((ahead - starts + 1) // width, ahead // width + 1):
                    # Distances of the cell's starts to the anchor, and of those among them that the row has.
                    near, far = cell * width, cell * width + width - 1
                    least, most = max(near, ahead - starts + 1), min(far, ahead)
                    shared = data[max(anchor - near, 0) : anchor - far + length]
                    made["key"].append(_number(hashlib.blake2b(shared, digest_size=8, key=b"%d %d" % (item["key"], cell)).digest()))
                    kind1, kind2 = _kind(data[anchor - most : anchor - least + length])
                    made["kind1"].append(kind1)
                    made["kind2"].append(kind2)
                    made["place"].append(_packed_place(anchor - most, most - least + 1, most))
                    made["text"].append(text)
                    made["copies"].append(1 if item["alone"] else 2)
        return made

    return arrow_rows(_with_texts(rows, texts, ["alone"]), work, WINDOWS)


def _cut(rows: DataFrame, texts: DataFrame, length: int) -> DataFrame:
    """The bytes of window rows."""

    def work(block: dict[str, list]) -> dict[str, list]:
        made: dict[str, list] = {name: [] for name in ("key", "kinds", "text", "start", "alone", "data")}
        unpack = zstandard.ZstdDecompressor().decompress
        for text, packed, wanted in zip(block["text"], block["packed"], block["wanted"]):
            data = unpack(packed)
            for item in wanted:
                start, starts, _ = _unpacked_place(item["place"])
                made["key"].append(item["key"])
                made["kinds"].append(item["kinds"])
                made["text"].append(text)
                made["start"].append(start)
                made["alone"].append(item["alone"])
                made["data"].append(data[start : start + starts + length - 1])
        return made

    return arrow_rows(_with_texts(rows, texts, ["kinds", "alone"]), work, "key long, kinds long, text binary, start long, alone boolean, data binary")


def shared_starts(groups: list[list[bytes]], length: int) -> list[list[np.ndarray]]:
    """Of every byte string, the starts of ``length``-byte strings that stand elsewhere in its group, by suffix arrays of the groups."""
    marks = max(map(len, groups), default=0) + 1
    data, sizes, owners = [], [], []
    for g, group in enumerate(groups):
        for i, piece in enumerate(group):
            data += [np.frombuffer(piece, np.uint8).astype(np.uint16) + np.uint16(marks), np.array([i + 1], np.uint16)]
            owners.append((g, i, len(piece)))
        data.append(np.zeros(1, np.uint16))
        sizes.append(sum(map(len, group)) + len(group) + 1)
    text = np.concatenate(data)
    ordered = suffix_arrays(text, sizes)
    close = np.flatnonzero(common_prefixes(text, sizes, ordered) >= length)
    shared = np.zeros(len(text), bool)
    shared[ordered[close]] = True
    shared[ordered[close - 1]] = True
    made: list[list[np.ndarray]] = [[] for _ in groups]
    at = 0
    for g, i, size in owners:
        made[g].append(np.flatnonzero(shared[at : at + size]))
        at += size + 1 + (i + 1 == len(groups[g]))
    return made


def _compared(cut: DataFrame, length: int) -> DataFrame:
    """``text, low, high``: runs of bytes covered by strings that other rows of the key hold too."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    schema = _parse_datatype_string("text binary, low long, high long")
    target = to_arrow_schema(schema)

    def runs(rows: list[tuple]) -> pa.RecordBatch:
        keys = np.array([r[0] for r in rows])
        first = np.append(0, np.flatnonzero(keys[1:] != keys[:-1]) + 1).tolist()
        groups = [rows[a:b] for a, b in zip(first, [*first[1:], len(rows)])]
        found: list[tuple] = []
        for group, starts in zip(groups, shared_starts([[r[4] for r in g] for g in groups], length)):
            for (_, text, start, alone, _), at in zip(group, starts):
                if alone and len(at):
                    edge = np.flatnonzero(np.diff(at) > 1)
                    low, high = at[np.append(0, edge + 1)] + start, at[np.append(edge, len(at) - 1)] + start + length
                    found += [(text, a, b) for a, b in zip(low.tolist(), high.tolist())]
        return pa.RecordBatch.from_arrays([pa.array([f[i] for f in found], c.type) for i, c in enumerate(target)], schema=target)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, size = [], 0
        for batch in batches:
            for row in zip(*[batch.column(i).to_pylist() for i in range(5)]):
                if size >= PIECE and row[0] != rows[-1][0]:
                    yield runs(rows)
                    rows, size = [], 0
                rows.append(row)
                size += len(row[4])
        if rows:
            yield runs(rows)
        rows = batch = None
        give_back()

    importable(cut.sparkSession)
    # Keys of like size stand together, so that texts of like length take their steps together.
    placed = cut.repartition("key").sortWithinPartitions("kinds", "key")
    return placed.select("key", "text", "start", "alone", "data").mapInArrow(run, schema)


def _covered(found: DataFrame, length: int) -> DataFrame:
    """The bytes of repeated window rows as ``text, low, high``."""
    start = F.shiftright("place", 20)
    starts = F.shiftright("place", 10).bitwiseAND(F.lit(1023))
    return found.where("repeated").select("text", start.alias("low"), (start + starts + (length - 1)).alias("high"))


def repeated_runs(texts: DataFrame, length: int = LENGTH) -> DataFrame:
    """``text, low, high``: overlapping runs that cover what stands elsewhere too, of texts that occur once."""
    rows = materialise(windows(texts, length), "windows")
    covered, open_rows = [], []
    for width in (*CELLS, None):
        found = _settle(rows)
        covered.append(_covered(found, length))
        left = found.where("open")
        open_rows.append(left.where(F.col("kinds") <= CROWD))
        crowded = left.where(F.col("kinds") > CROWD)
        if width is None or crowded.isEmpty():
            break
        rows = materialise(_cells(crowded, texts, width, length), "window-cells")
    compared = _compared(_cut(reduce(DataFrame.unionByName, open_rows), texts, length), length)
    return reduce(DataFrame.unionByName, [*covered, compared])


def remove_repeats(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256`` per row of ``docs``.

    Texts are UTF-8 bytes, null counts as empty. A byte goes if a ``length``-byte
    string that covers it starts anywhere else too, in the same text or another;
    overlapping occurrences count, and all are judged on the texts as they are
    given. Texts shorter than ``length`` stay whole; of a text that several rows
    hold, all goes. Rows that repeat an id stand on their own, other columns do
    not matter. ``length`` lies between 337, for cells of 64 starts, and 1,000.
    """
    if not 337 <= length <= 1000:
        raise ValueError("length must lie between 337 and 1000")
    texts = gathered_texts(docs)
    spans = repeated_runs(texts, length).groupBy("text").agg(F.collect_list(F.struct("low", "high")).alias("runs"))

    def work(block: dict[str, list]) -> dict[str, list]:
        made: dict[str, list] = {name: [] for name in ("text", "copies", "n_bytes", "n_removed", "n_spans", "kept_sha256")}
        unpack = zstandard.ZstdDecompressor().decompress
        for packed, copies, found in zip(block["packed"], block["copies"], block["runs"]):
            data = unpack(packed)
            runs = [(0, len(data))] if copies > 1 and len(data) >= length else sorted((r["low"], r["high"]) for r in found or [])
            merged: list[list[int]] = []
            for low, high in runs:
                if merged and low <= merged[-1][1]:
                    merged[-1][1] = max(merged[-1][1], high)
                else:
                    merged.append([low, high])
            kept, at = hashlib.sha256(), 0
            for low, high in merged:
                kept.update(data[at:low])
                at = high
            kept.update(data[at:])
            made["n_bytes"].append(len(data))
            made["n_removed"].append(sum(high - low for low, high in merged))
            made["n_spans"].append(len(merged))
            made["kept_sha256"].append(kept.hexdigest())
        made["text"], made["copies"] = block["text"], block["copies"]
        return made

    schema = "text binary, copies long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    told = materialise(arrow_rows(texts.join(spans, "text", "left"), work, schema), "text-results")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_digest(F.col("text")).alias("text"))
    total = told.agg(F.coalesce(F.sum("copies"), F.lit(0))).first()[0]
    large = told.where(F.col("copies") > max(total / SHARE, 100))  # so that there are at most a thousand
    results = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
    if large.isEmpty():
        return rows.join(told, "text").select(*results)
    # Copies of a much repeated text take its line from a broadcast.
    few = F.broadcast(large)
    rest = rows.join(F.broadcast(large.select("text")), "text", "left_anti").join(told, "text")
    return rows.join(few, "text").select(*results).unionByName(rest.select(*results))
