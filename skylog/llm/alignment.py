"""Which tokens of two tokenizers cover the same bytes.

Both sides of a text spell the same bytes, so that its tokens are two ways of
cutting one range. ``merge_asof``, keyed by document and offset, finds for every
token start the token of the other side that covers it; both directions together give all pairs of tokens that
overlap. Where a token of either side ends at the same byte, a group ends.

Documents pass in chunks of bounded size. A chunk keeps its links as places in
its own table of distinct id pairs, so that counting pairs over the corpus, and
bringing the counts back, moves a line per pair and chunk and not one per link.
"""

from __future__ import annotations

import gc
import hashlib
import json
import re
from array import array
from collections.abc import Iterator
from functools import lru_cache
from itertools import compress

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from skylog.llm.chunks import PIECE, SPACE, ChunkIds, byte_alphabet
from skylog.llm.common import arrow_rows, give_back, importable, materialise
from skylog.llm.simple8b import CHUNKS, TextEncoder

# Characters of text after which a chunk is full; a longer text is a chunk of its own.
CHUNK = 1 << 20
# Words of text whose ids of both sides are kept, in each of two generations, and chunks of side A beside them.
KEPT = 200_000
KEPT_A = 20_000
# New words that go through both sides together, and how few go one by one.
TOGETHER = 1 << 13
FEW = 64
# Characters of text whose tokens are aligned at a time; their pairs are counted by chunk.
STEP = 1 << 18
# An id of side B is below this, so that a pair of ids is one number; added to it, it marks it as of side B.
RADIX = 1 << 31

# White space that a word can begin with; it may belong to a run that began before the space.
BLANK = frozenset(re.findall(f"[{SPACE}]", "".join(map(chr, range(1 << 14)))))

SCHEMA = (
    "part int, place long, doc_ids array<long>, n_a array<long>, n_b array<long>, n_groups array<long>, n_links array<long>, "
    "groups_sha256 array<string>, pairs array<long>, counts array<long>, links binary"
)


class Sides:
    """Both tokenizers, with the bytes of every id."""

    def __init__(self, byte_level: str, piece_model: str) -> None:
        import sentencepiece

        self.a = TextEncoder(byte_level)
        self.a.tokenizer.encode_special_tokens = True
        self.a.added = []  # their strings are plain text here
        self.a.known = ChunkIds(self._spelling, KEPT_A)
        code = {c: b for b, c in enumerate(byte_alphabet())}
        with open(byte_level, encoding="utf-8") as file:
            told = json.load(file)
        spelled = {i: t for t, i in told["model"]["vocab"].items()} | {t["id"]: None for t in told["added_tokens"]}
        self.a_bytes = [b""] * (max(spelled) + 1)
        for i, token in spelled.items():
            if token is not None:
                self.a_bytes[i] = bytes(code[c] for c in token)
        self.b = sentencepiece.SentencePieceProcessor(model_file=piece_model)
        self.b_bytes = []
        for i in range(self.b.piece_size()):
            piece = self.b.id_to_piece(i)
            self.b_bytes.append(bytes([int(piece[3:5], 16)]) if self.b.is_byte(i) else piece.replace("▁", " ").encode())
        self.a_size = np.array([len(x) for x in self.a_bytes])
        self.b_size = np.array([len(x) for x in self.b_bytes])
        self.known = ChunkIds(self._word, KEPT)
        self.ready: dict[str, bytes] = {}  # ids of new words that are not kept yet
        self.by_word = self._cuttable()

    def _cuttable(self) -> bool:
        """Whether side B spells a text by its words: no piece goes on after a space that follows something else."""
        tokens = [self.b.id_to_piece(i) for i in range(self.b.piece_size())]
        return not any("▁" in token.lstrip("▁") for token in tokens) and self.b.encode("a b") == self.b.encode("a") + self.b.encode("b")

    def _spelling(self, chunk: str) -> bytes:
        """Ids of a run of text, or none if they do not spell it; a text with such a run is too short in bytes."""
        ids = self.a._chunk(chunk)
        return ids if b"".join(map(self.a_bytes.__getitem__, array("I", ids))) == chunk.encode() else b""

    def _word(self, word: str) -> bytes:
        """Ids of both sides for a space and a word, those of side B marked; none if a side does not spell them, or white space may go on."""
        if (ids := self.ready.pop(word, None)) is not None:
            return ids
        chunk = " " + word
        if not word or word[0] in BLANK:
            return b""
        a = self.a._chunk(chunk) if word.isalpha() else self.a.known.of_text(chunk, CHUNKS)
        b = self.b.encode(word)
        spelled = chunk.encode()
        if b"".join(map(self.a_bytes.__getitem__, array("I", a))) != spelled or b"".join(map(self.b_bytes.__getitem__, b)) != spelled:
            return b""
        return a + array("I", [RADIX + i for i in b]).tobytes()

    def _words(self, words: list[str]) -> None:
        """Make the ids of new words ready, as ``_word`` has them; words that a side does not spell are left to it."""
        of_b = self.b.encode(words, num_threads=1)
        spelled = (" " + " ".join(words)).encode()
        if b"".join([self.b_bytes[i] for ids in of_b for i in ids]) != spelled:
            good = [b"".join(map(self.b_bytes.__getitem__, ids)) == (" " + w).encode() for w, ids in zip(words, of_b)]
            words, of_b = list(compress(words, good)), list(compress(of_b, good))
            spelled = (" " + " ".join(words)).encode()
        if not words:
            return
        a = np.array(self.a.tokenizer.encode_batch_fast([spelled.decode()], add_special_tokens=False)[0].ids, np.int64)
        b = np.array([i for ids in of_b for i in ids], np.int64)
        ends = np.cumsum([len(w.encode()) + 1 for w in words])
        end_a, end_b = np.cumsum(self.a_size[a]), np.cumsum(self.b_size[b])
        last = np.searchsorted(end_a, ends)
        if b"".join(map(self.a_bytes.__getitem__, a.tolist())) != spelled or (end_a[last] != ends).any():
            return
        # The ids of a word lie side by side, those of side A first.
        order = np.argsort(np.concatenate([np.searchsorted(ends, end_a) * 2, np.searchsorted(ends, end_b) * 2 + 1]), kind="stable")
        ids = np.concatenate([a, b + RADIX])[order].astype("<u4").tobytes()
        upto = (4 * (last + 1 + np.cumsum(list(map(len, of_b))))).tolist()
        self.ready.update((w, ids[start:end]) for w, start, end in zip(words, [0, *upto], upto))

    def _prepare(self, texts: list[str]) -> None:
        """Make the new words of texts ready, many together."""
        known, old = self.known, self.known.old
        seen = {w for t in texts if len(t) <= PIECE for w in t.split(" ")}
        new = [w for w in seen if w and w not in known and w not in old and w[0] not in BLANK]
        for at in range(0, len(new) if len(new) > FEW else 0, TOGETHER):
            self._words(new[at : at + TOGETHER])

    def encode(self, texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Ids of both sides; none where a text is empty or a side does not spell space and text."""
        collecting = gc.isenabled()
        gc.disable()  # as in the encoder of side A
        try:
            if self.by_word:
                self._prepare(texts)
            return iter([self._text(t) for t in texts])
        finally:
            self.ready.clear()
            if collecting:
                gc.enable()

    def _text(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """Word by word where that spells the text, else whole."""
        if self.by_word and len(text) <= PIECE:
            ids = np.frombuffer(b"".join(map(self.known.__getitem__, text.split(" "))), np.uint32)
            of_b = ids >= RADIX
            a, b = ids[~of_b].astype(np.int64), ids[of_b].astype(np.int64) - RADIX
            if self.a_size[a].sum() == len(text.encode()) + 1 == self.b_size[b].sum():
                return a, b
        whole = (" " + text).encode()
        a = np.frombuffer(self.a.encode([" " + text])[0], np.uint32).astype(np.int64)
        b = self.b.encode(text, num_threads=1) if text else []
        if text and self.a_size[a].sum() == len(whole) and b"".join(map(self.b_bytes.__getitem__, b)) == whole:
            return a, np.array(b, np.int64)
        return np.empty(0, np.int64), np.empty(0, np.int64)


@lru_cache(maxsize=1)
def _sides(byte_level: str, piece_model: str) -> Sides:
    return Sides(byte_level, piece_model)


def overlaps(start_a: np.ndarray, start_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the tokens of both sides that overlap, ordered by place.

    A start is the base of its document, which no other shares, plus the offset
    in it, and so names the document as well; starts ascend over all of them, and
    the first token of a document starts at its base on both sides. A start is
    covered by the last token of the other side that starts at or before it.
    """
    a = pd.DataFrame({"start": start_a, "a": np.arange(len(start_a))})
    b = pd.DataFrame({"start": start_b, "b": np.arange(len(start_b))})
    width = max(len(start_b), 1)
    both = [pd.merge_asof(one, other, on="start") for one, other in ((a, b), (b, a))]
    links = np.sort(np.concatenate([found["a"].to_numpy(np.int64) * width + found["b"].to_numpy(np.int64) for found in both]))
    links = links[np.append(True, links[1:] != links[:-1])[: len(links)]]
    return links // width, links % width


def _digits(ids: np.ndarray, after: np.ndarray) -> tuple[bytes, np.ndarray]:
    """Decimal ids, each followed by its mark, as one string, and where each ends; a mark of 0 is left out."""
    if not len(ids):
        return b"", np.empty(0, np.int64)
    width = len(str(int(ids.max())))
    grid = np.empty((len(ids), width + 1), np.uint8)
    small = rest = ids.astype(np.uint32)
    for column in range(width - 1, -1, -1):
        tens = rest // np.uint32(10)
        grid[:, column] = rest - tens * np.uint32(10) + np.uint32(48)
        rest = tens
    grid[:, width] = after
    shown = np.empty(grid.shape, bool)
    for column in range(width - 1):
        shown[:, column] = small >= np.uint32(10 ** (width - 1 - column))
    shown[:, width - 1] = True
    shown[:, width] = after > 0
    return grid[shown].tobytes(), np.cumsum(shown.sum(axis=1))


def _spelled_groups(doc_a: np.ndarray, group_a: np.ndarray, ids_a: np.ndarray, doc_b: np.ndarray, group_b: np.ndarray, ids_b: np.ndarray, docs: int) -> list[str]:
    """The digest of ``a1,a2|b1;a3|b2,b3`` of every document; an empty string without tokens."""
    group = np.concatenate([group_a, group_b])
    order = np.argsort(group * 2 + np.repeat([0, 1], [len(group_a), len(group_b)]), kind="stable")
    side = (order >= len(group_a)).astype(np.int64)
    key, doc = group[order] * 2 + side, np.concatenate([doc_a, doc_b])[order]
    last = np.append(doc[1:] != doc[:-1], True)[: len(doc)]
    change = np.append(key[1:] != key[:-1], True)[: len(key)]
    mark = np.where(last, 0, np.where(~change, ord(","), np.where(side == 0, ord("|"), ord(";"))))
    text, ends = _digits(np.concatenate([ids_a, ids_b])[order], mark)
    made = [""] * docs
    at = 0
    for i in np.flatnonzero(last):
        made[doc[i]] = hashlib.sha256(text[at : ends[i]]).hexdigest()
        at = ends[i]
    return made


def _steps(texts: list[str]) -> Iterator[list[str]]:
    """Texts in order, some at a time; at least one."""
    step, size = [], 0
    for text in texts:
        step.append(text)
        size += len(text)
        if size >= STEP:
            yield step
            step, size = [], 0
    if step:
        yield step


def align(sides: Sides, texts: list[str]) -> dict[str, list]:
    """Counts and group digests of every text, and the links of all as places in the table of distinct pairs."""
    made: dict[str, list] = {name: [] for name in ("n_a", "n_b", "n_groups", "n_links", "groups_sha256")}
    tables, counted, places = [], [], []
    for step in _steps(texts):
        part, linked = _aligned(sides, step)
        for name, values in part.items():
            made[name] += values
        pairs, place, counts = np.unique(linked, return_inverse=True, return_counts=True)
        tables.append(pairs)
        counted.append(counts)
        places.append(place.astype("<u4"))
    pairs, place = np.unique(np.concatenate(tables), return_inverse=True)
    counts = np.zeros(len(pairs), np.int64)
    np.add.at(counts, place, np.concatenate(counted))
    to = np.split(place.astype("<u4"), np.cumsum([len(x) for x in tables])[:-1])
    links = b"".join([whole[of_step].tobytes() for whole, of_step in zip(to, places)])
    return made | {"pairs": pairs, "counts": counts, "links": zstandard.ZstdCompressor(level=1).compress(links)}


def _aligned(sides: Sides, texts: list[str]) -> tuple[dict[str, list], np.ndarray]:
    """Counts and group digests of every text, and the pair of ids of every link."""
    docs = len(texts)
    ids = list(sides.encode(texts))
    counts_a, counts_b = np.array([len(a) for a, _ in ids], np.int64), np.array([len(b) for _, b in ids], np.int64)
    ids_a, ids_b = np.concatenate([a for a, _ in ids]), np.concatenate([b for _, b in ids])
    doc_a, doc_b = np.repeat(np.arange(docs), counts_a), np.repeat(np.arange(docs), counts_b)
    # Documents lie one after the other, so that offsets ascend and no two share an end.
    end_a, end_b = np.cumsum(sides.a_size[ids_a]), np.cumsum(sides.b_size[ids_b])
    link_a, link_b = overlaps(end_a - sides.a_size[ids_a], end_b - sides.b_size[ids_b])
    ends = np.intersect1d(end_a, end_b, assume_unique=True)
    group_a, group_b = np.searchsorted(ends, end_a), np.searchsorted(ends, end_b)
    group_doc = doc_a[np.searchsorted(end_a, ends)]
    made = {
        "n_a": counts_a.tolist(),
        "n_b": counts_b.tolist(),
        "n_groups": np.bincount(group_doc, minlength=docs).tolist(),
        "n_links": np.bincount(doc_a[link_a], minlength=docs).tolist(),
        "groups_sha256": _spelled_groups(doc_a, group_a, ids_a, doc_b, group_b, ids_b, docs),
    }
    return made, ids_a[link_a] * RADIX + ids_b[link_b]


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, list]]:
    ids, texts, size = [], [], 0
    for batch in batches:
        for i, text in zip(batch.column(0), batch.column(1)):
            ids.append(i.as_py())
            texts.append(text.as_py() or "")
            size += len(texts[-1])
            if size >= CHUNK:
                yield ids, texts
                ids, texts, size = [], [], 0
    if ids:
        yield ids, texts


def aligned_chunks(docs: DataFrame, byte_level: str, piece_model: str) -> DataFrame:
    """A line per chunk of documents, written to the shared folder."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    schema = _parse_datatype_string(SCHEMA)
    target = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, sides = TaskContext.get().partitionId(), _sides(byte_level, piece_model)
        for place, (ids, texts) in enumerate(_chunks(batches)):
            line = {"part": part, "place": place, "doc_ids": ids, **align(sides, texts)}
            yield pa.RecordBatch.from_arrays([pa.array([line[f.name]], f.type) for f in target], schema=target)
            ids = texts = line = None
            give_back()

    importable(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return materialise(rows.mapInArrow(run, schema), "aligned")


def pair_counts(chunks: DataFrame) -> DataFrame:
    """``part, place, pair, count, best`` for the pairs of every chunk: links that hold the pair in the whole corpus, and whether no pair with its B id has more."""
    held = chunks.select("part", "place", F.explode(F.arrays_zip("pairs", "counts")).alias("held"))
    held = held.select("part", "place", F.col("held.pairs").alias("pair"), F.col("held.counts").alias("links"))
    total = held.groupBy("pair").agg(F.sum("links").alias("count")).withColumn("b", F.col("pair") % RADIX)
    most = total.groupBy("b").agg(F.max("count").alias("most"))
    told = total.join(most, "b").select("pair", "count", (F.col("count") == F.col("most")).alias("best"))
    return held.select("part", "place", "pair").join(told, "pair")


def alignment(docs: DataFrame, byte_level: str, piece_model: str) -> DataFrame:
    """``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256`` per document.

    Side A encodes space and text by a byte-level file of the tokenizers library,
    side B the text by a sentencepiece model, which adds the space. Both paths
    hold on all machines. Null and empty texts, and texts that a side does not
    spell back byte for byte, have no tokens: zeros and an empty digest. Rows that
    repeat an id stand on their own; other columns do not matter.
    """
    chunks = aligned_chunks(docs, byte_level, piece_model)
    counted = pair_counts(chunks).groupBy("part", "place").agg(F.sort_array(F.collect_list(F.struct("pair", "count", "best"))).alias("told"))
    kept = chunks.drop("pairs", "counts").join(counted, ["part", "place"], "left")
    kept = kept.select("*", F.col("told.count").alias("count"), F.col("told.best").alias("best")).drop("told", "part", "place")
    plain = ["n_a", "n_b", "n_groups", "n_links"]

    def work(block: dict[str, list]) -> dict[str, list]:
        made: dict[str, list] = {name: [] for name in ("doc_id", *plain, "n_best", "count_sum", "groups_sha256")}
        for i, links in enumerate(block["links"]):
            made["doc_id"] += block["doc_ids"][i]
            for name in (*plain, "groups_sha256"):
                made[name] += block[name][i]
            place = np.frombuffer(zstandard.ZstdDecompressor().decompress(links), "<u4")
            doc_ends = np.append(0, np.cumsum(block["n_links"][i]))
            for name, column in (("n_best", "best"), ("count_sum", "count")):
                before = np.append(0, np.cumsum(np.array(block[column][i] or [0], np.int64)[place]))
                made[name] += np.diff(before[doc_ends]).tolist()
        return made

    schema = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"
    return arrow_rows(kept, work, schema, rows=1)
