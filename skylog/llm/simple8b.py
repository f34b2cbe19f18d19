"""Token ids in Simple-8b blocks.

Ids are packed greedily into 64-bit words: four bits say how many ids a word
holds and in how many bits each, and an id too wide for any of those stands
alone in the word after an escape. Blocks of ``BLOCK`` ids begin at a word of
their own, and the offsets of those words are kept, so that blocks are packed
and unpacked side by side, each step for all of them at once.

A token file is a Parquet table, a line per group of documents in ascending id
order: ``part, place`` (the order of lines), ``doc_ids``, ``lengths`` (ids per
document), ``n_ids``, ``offsets`` and ``words`` (little-endian bytes).
"""

from __future__ import annotations

import gc
import os
import re
import zlib
from array import array
from collections.abc import Iterator
from functools import lru_cache
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from skylog.llm.chunks import PIECE, SPACE, ChunkIds, byte_alphabet
from skylog.llm.common import arrow_rows, importable

BLOCK = 1024
# Selector k holds COUNTS[k] ids of WIDTHS[k] bits; 15 is the escape, and 0 is not used.
COUNTS = np.array([0, 60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1, 1])
WIDTHS = np.array([0, 1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 60, 64])
ESCAPE = 15
MARGIN = 64
# Chunks whose ids a worker keeps, in each of two generations; some 250 MB in all.
KEPT = 1_000_000
# A line of a token file holds about this many characters of text, and at least one document.
LINE = 1 << 20
# Lines that are encoded together.
TOGETHER = 4

_U = np.uint64
_POWERS = _U(1) << np.arange(64, dtype=_U)
_SMALL = np.searchsorted(_POWERS, np.arange(1 << 16, dtype=_U), "right").astype(np.uint8)


def _selectors(bits: np.ndarray) -> np.ndarray:
    """The selector a word beginning at each id would have: the one with most ids that all fit."""
    width = bits.shape[1] - MARGIN
    best = np.full((len(bits), width), ESCAPE, np.uint8)
    # Each selector holds more and narrower ids than the next: what fits one fits all after it, so fits are counted.
    widest = {1: bits}  # over the next 1, 2, 4, ... ids
    for k in (1, 2, 4, 8, 16):
        wider = widest[k].copy()
        np.maximum(wider[:, :-k], widest[k][:, k:], out=wider[:, :-k])
        widest[2 * k] = wider
    for selector in range(14, 0, -1):
        count = int(COUNTS[selector])
        span = 1 << (count.bit_length() - 1)
        over = np.maximum(widest[span][:, :width], widest[span][:, count - span : count - span + width])
        fits = over <= WIDTHS[selector]
        if not fits.any():
            break
        best -= fits
    return best


def pack(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Words, and the first word of every block."""
    ids = ids.astype(_U)
    blocks = -(-len(ids) // BLOCK)
    grid = np.zeros((blocks, BLOCK + MARGIN), _U)
    lengths = np.full(blocks, BLOCK)
    if blocks:
        lengths[-1] = len(ids) - (blocks - 1) * BLOCK
        flat = np.zeros(blocks * BLOCK, _U)
        flat[: len(ids)] = ids
        grid[:, :BLOCK] = flat.reshape(blocks, BLOCK)
    small = len(ids) == 0 or int(ids.max()) < 1 << 16
    bits = _SMALL[grid] if small else np.searchsorted(_POWERS, grid, "right").astype(np.uint8)
    selector = _selectors(bits)

    # Places in the grid, row by row: every block walks from word to word, all of them at once.
    flat, selector = grid.reshape(-1), np.pad(selector, ((0, 0), (0, MARGIN))).reshape(-1)
    step = COUNTS[selector]
    at, end = np.arange(blocks) * (BLOCK + MARGIN), np.arange(blocks) * (BLOCK + MARGIN) + lengths
    begins = np.zeros(len(flat), bool)
    while len(at):
        begins[at] = True
        at = at + step.take(at)
        going = at < end
        if not going.all():
            at, end = at[going], end[going]
    at = np.flatnonzero(begins)
    chosen = selector[at]
    sizes = 1 + (chosen == ESCAPE)
    place = np.cumsum(sizes) - sizes
    offsets = place[np.searchsorted(at, np.arange(blocks) * (BLOCK + MARGIN))]
    words = np.zeros(int(sizes.sum()), _U)
    for s in np.flatnonzero(np.bincount(chosen)):
        here = np.flatnonzero(chosen == s)
        if s == ESCAPE:
            words[place[here]] = _U(ESCAPE) << _U(60)
            words[place[here] + 1] = flat[at[here]]
            continue
        held = np.full(len(here), _U(s) << _U(60))
        for i in range(COUNTS[s]):
            held |= flat.take(at[here] + i) << _U(i * WIDTHS[s])
        words[place[here]] = held
    return words.astype("<u8"), offsets.astype("<u4")


def unpack(words: np.ndarray, offsets: np.ndarray, n: int) -> np.ndarray:
    """The ``n`` ids of all blocks."""
    blocks = len(offsets)
    if not n:
        return np.empty(0, _U)
    selector = (words >> _U(60)).astype(np.int64)
    follows = np.zeros(len(words), bool)  # words that hold what an escape stands for
    for i in np.flatnonzero(selector == ESCAPE):
        if not follows[i]:
            follows[i + 1] = True
    counts = np.where(follows, 0, COUNTS[selector])
    lane = np.repeat(np.arange(blocks), np.diff(np.append(offsets.astype(np.int64), len(words))))
    before = np.cumsum(counts) - counts
    at = before - before[offsets.astype(np.int64)][lane]
    grid = np.zeros((blocks, BLOCK + MARGIN), _U)
    for s in np.unique(selector[~follows]):
        here = np.flatnonzero((selector == s) & ~follows)
        if s == ESCAPE:
            grid[lane[here], at[here]] = words[here + 1]
            continue
        each = np.arange(COUNTS[s])
        held = (words[here, None] >> (each * WIDTHS[s]).astype(_U)) & _U((1 << int(WIDTHS[s])) - 1)
        grid[lane[here, None], at[here, None] + each] = held
    return grid[:, :BLOCK].reshape(-1)[:n]


# Where a byte-level pre-token may end: a space belongs to the run after it, other white space to itself.
CHUNKS = re.compile(f" ?[^{SPACE}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+")


# White space of more than one byte in UTF-8.
_WIDE = re.compile("[" + "".join(c for c in SPACE if c > "\x7f") + "]")
# By byte: ASCII white space, marks that no letter shares a pre-token with, letters of ASCII, first of two bytes that are a letter (but for U+00D7 and U+00F7).
_SPACES, _MARKS, _LETTERS, _LEADS = (
    np.isin(np.arange(256), list(these))
    for these in (b"\t\n\v\f\r ", b".,;:!?", bytes(range(65, 91)) + bytes(range(97, 123)), bytes([*range(0xC3, 0xCA), 0xD0, 0xD1]))
)

# The pre-tokens of a chunk of ASCII, as the byte-level pattern has them.
_ASCII = re.compile(r"'(?:s|t|re|ve|m|ll|d)| ?[A-Za-z]+| ?[0-9]+| ?[^\sA-Za-z0-9]+|\s+(?!\S)|\s+", re.ASCII)


def _begins(data: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Where chunks begin in texts that lie one after the other in UTF-8, from ``starts`` on; their white space is all ASCII.

    The chunks are those of ``CHUNKS``, cut once more between a letter and a mark.
    """
    space = _SPACES[data]
    begins = np.zeros(len(data) + 1, bool)
    begins[1:-1] = space[1:] & ~space[:-1]
    into = space[:-1] & ~space[1:]  # white space, and a word behind it
    into[starts[(starts > 0) & (starts < len(data))] - 1] = False
    into = np.flatnonzero(into)
    begins[into] = True
    begins[into[data[into] != 32] + 1] = True
    mark = np.flatnonzero(_MARKS[data])
    mark = mark[mark > 1]
    last, lead = data[mark - 1], data[mark - 2]
    letter = _LETTERS[last] | (_LEADS[lead] & (last & 0xC0 == 0x80) & ((lead != 0xC3) | (last & 0xDF != 0x97)))
    begins[mark[letter]] = True
    begins[starts] = True
    return np.flatnonzero(begins[:-1])


class TextEncoder:
    """Ids of whole texts by the tokenizers library, chunk by chunk.

    A chunk that is one word goes to the library's model as its byte-level
    pre-tokenizer would spell it. One that is all of ASCII, or a word and a mark, is
    cut as that pre-tokenizer cuts it, and its parts are looked up in turn. Any
    other chunk goes through the whole library.

    ``encode`` looks up every chunk of a text, ``encode_block`` every different one
    of many texts.
    """

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.tokenize = self.tokenizer.model.tokenize
        self.code = [i.to_bytes(4, "little") for i in range(max(self.tokenizer.get_vocab().values()) + 1)]
        self.letters = dict(enumerate(byte_alphabet()))
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.known = ChunkIds(self._chunk, KEPT)

    def _word(self, word: str) -> bytes:
        if word.isascii() and word.isprintable():  # of these only the space has another letter
            spelled = word.replace(" ", self.letters[32])
        else:
            spelled = word.encode("utf-8").decode("latin-1").translate(self.letters)
        return b"".join([self.code[t.id] for t in self.tokenize(spelled)])

    def _whole(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def _chunk(self, chunk: str) -> bytes:
        word = chunk[1:] if chunk[0] == " " else chunk
        if word.isalpha():
            return self._word(chunk)
        if chunk.isascii():
            parts = _ASCII.findall(chunk)
            return b"".join(map(self.known.__getitem__, parts)) if len(parts) > 1 else self._word(chunk)
        if chunk[-1] in ".,;:!?" and word[:-1].isalpha():
            return self.known[chunk[:-1]] + self.known[chunk[-1]]
        return array("I", self._whole(chunk)).tobytes()

    def encode(self, texts: list[str]) -> list[bytes]:
        """Texts that hold an added token go to the library whole: such a token ends the white space before it.

        The store holds no cycles, so that the collector has nothing to find in it.
        """
        collecting = gc.isenabled()
        gc.disable()
        try:
            return [
                np.array(self._whole(t), "<u4").tobytes() if any(a in t for a in self.added) else self.known.of_text(t, CHUNKS)
                for t in texts
            ]
        finally:
            if collecting:
                gc.enable()

    def encode_block(self, texts: list[str]) -> list[bytes]:
        """As ``encode``; chunks of all texts are told apart by Arrow, and each is looked up once."""
        plain = [len(t) <= PIECE and (t.isascii() or not _WIDE.search(t)) and not any(a in t for a in self.added) for t in texts]
        raw = [t.encode("utf-8") if p else b"" for t, p in zip(texts, plain)]
        data, starts = b"".join(raw), np.cumsum([0, *map(len, raw)])
        if not data:
            return self.encode(texts)
        begins = _begins(np.frombuffer(data, np.uint8), starts)
        bounds = np.append(begins, len(data)).astype("<i4")
        chunks = pa.Array.from_buffers(pa.string(), len(begins), [None, pa.py_buffer(bounds), pa.py_buffer(data)]).dictionary_encode()
        collecting = gc.isenabled()
        gc.disable()
        try:
            known = pa.array(map(self.known.__getitem__, chunks.dictionary.to_numpy(zero_copy_only=False)), pa.binary())
        finally:
            if collecting:
                gc.enable()
        made = known.take(chunks.indices)
        ids = memoryview(made.buffers()[2])
        at = np.frombuffer(made.buffers()[1], "<i4")[np.searchsorted(begins, starts)].tolist()
        return [bytes(ids[a:b]) if p else self.encode([t])[0] for t, p, a, b in zip(texts, plain, at, at[1:])]


@lru_cache(maxsize=2)
def _encoder(path: str) -> TextEncoder:
    return TextEncoder(path)


FILE_SCHEMA = "part int, place long, doc_ids array<long>, lengths array<long>, n_ids long, offsets binary, words binary"


def write_tokens(docs: DataFrame, path: str, tokenizer: str, end_id: int = 0, id_column: str = "doc_id", text_column: str = "text") -> None:
    """Write the ids of all texts, each with ``end_id`` after it, in ascending id order.

    ``tokenizer`` is the path of a file of the tokenizers library, byte-level,
    the same on all machines. Null texts count as empty, null ids come first,
    rows that repeat an id stand in the order of their texts. An empty table
    makes a file without lines.
    """
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    schema = _parse_datatype_string(FILE_SCHEMA)
    target = to_arrow_schema(schema)
    end = np.array([end_id], "<u4").tobytes()

    def lines(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, list]]:
        ids, texts, size = [], [], 0
        for batch in batches:
            for i, text in zip(batch.column(0), batch.column(1)):
                ids.append(i.as_py())
                texts.append(text.as_py() or "")
                size += len(texts[-1])
                if size >= LINE:
                    yield ids, texts
                    ids, texts, size = [], [], 0
        if ids:
            yield ids, texts

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, encoder = TaskContext.get().partitionId(), _encoder(tokenizer)

        def encoded() -> Iterator[tuple[list, list[bytes]]]:
            whole_lines = lines(batches)
            while block := list(islice(whole_lines, TOGETHER)):
                made = iter(encoder.encode_block([text for _, texts in block for text in texts]))
                yield from [(ids, [next(made) + end for _ in ids]) for ids, _ in block]

        for place, (ids, coded) in enumerate(encoded()):
            whole = np.frombuffer(b"".join(coded), "<u4")
            words, offsets = pack(whole)
            line = [part, place, ids, [len(c) // 4 for c in coded], len(whole), offsets.tobytes(), words.tobytes()]
            yield pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(line, target)], schema=target)

    importable(docs.sparkSession)
    rows = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).cast("string").alias("text"))
    ordered = rows.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    ordered.mapInArrow(run, schema).write.option("compression", "zstd").parquet(path)


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """The lines of a file with the number of ids before each: sums per part first, then within parts."""
    lines = spark.read.parquet(path)
    parts = lines.groupBy("part").agg(F.sum("n_ids").alias("part_ids"))
    ordered = Window.orderBy("part")  # a line per part
    parts = parts.select("part", (F.sum("part_ids").over(ordered) - F.col("part_ids")).alias("part_start"))
    within = Window.partitionBy("part").orderBy("place")
    places = lines.select("part", "place", (F.sum("n_ids").over(within) - F.col("n_ids")).alias("line_start"))
    starts = places.join(parts, "part").select("part", "place", (F.col("part_start") + F.col("line_start")).alias("start"))
    return lines.join(starts, ["part", "place"])


def _documents(block: dict[str, list]) -> Iterator[tuple[int | None, int, np.ndarray]]:
    for i, words in enumerate(block["words"]):
        ids = unpack(np.frombuffer(words, "<u8"), np.frombuffer(block["offsets"][i], "<u4"), block["n_ids"][i])
        at = 0
        for doc_id, n in zip(block["doc_ids"][i], block["lengths"][i]):
            yield doc_id, block["start"][i] + at, ids[at : at + n]
            at += n


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id, start`` (ids of all documents before it), ``ids``."""

    def work(block: dict[str, list]) -> dict[str, list]:
        found = list(_documents(block))
        return {"doc_id": [d for d, _, _ in found], "start": [s for _, s, _ in found], "ids": [x.astype(np.int64) for _, _, x in found]}

    return arrow_rows(_lines(spark, path), work, "doc_id long, start long, ids array<long>", rows=1)


def token_checksums(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of what the files hold."""

    def work(block: dict[str, list]) -> dict[str, list]:
        found = list(_documents(block))
        return {
            "doc_id": [d for d, _, _ in found],
            "start": [s for _, s, _ in found],
            "n_tokens": [len(x) for _, _, x in found],
            "ids_crc32": [zlib.crc32(x.astype("<u4").tobytes()) for _, _, x in found],
        }

    return arrow_rows(_lines(spark, path), work, "doc_id long, start long, n_tokens long, ids_crc32 long", rows=1)
