"""Byte-pair encoding by backtracking, and decoding by an offset table.

The encoder walks a word once. An Aho-Corasick automaton names the longest token
at every place; a token is taken if it may stand after the one before it, and if
none may, the one before it is given up for a shorter one. Two tokens may stand
side by side if merging would not have joined across their border, which is seen
by undoing their merges in reverse order. As every place is given up at most
once, the work is linear in the word, and the result is that of the merges.
"""

from __future__ import annotations

import hashlib
import json
import re
import unicodedata
from functools import lru_cache

import ahocorasick
import numpy as np
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from skylog.llm.chunks import KEPT, SPACE, ChunkIds, byte_alphabet
from skylog.llm.common import arrow_rows

# Stands for the end of a word within the automaton; the byte alphabet does not have it.
END = "\0"
# Ids that are turned into text at once.
SLICE = 1 << 19
# Letters and marks below this one (Latin, Greek and Cyrillic) are the same in all tables of Unicode in use.
SETTLED = "\u0530"
# Pairs of tokens whose compatibility is kept.
PAIRS = 1 << 20


class PairEncoder:
    """Exact byte-pair encoding of words with an end-of-word suffix."""

    def __init__(self, vocabulary: dict[str, int], merges: list[tuple[str, str]], suffix: str) -> None:
        def inner(token: str) -> str:
            return token[: -len(suffix)] + END if suffix and token.endswith(suffix) and token != suffix else token

        self.suffix = bool(suffix)
        alphabet = byte_alphabet()
        self.letters = {b: c for b, c in enumerate(alphabet)}
        base = [c + s for s in ("", suffix)[: 1 + self.suffix] for c in alphabet]
        self.split: dict[int, tuple[int, int]] = {vocabulary[t]: (vocabulary[t],) * 2 for t in base if t in vocabulary}
        self.joined: dict[tuple[int, int], int] = {}
        self.rank = {i: -1 for i in self.split}
        spelled = {inner(t): vocabulary[t] for t in base if t in vocabulary}
        for rank, (left, right) in enumerate(merges):
            made = vocabulary[left + right]
            pair = (vocabulary[left], vocabulary[right])
            self.joined.setdefault(pair, made)
            if made not in self.split:
                self.split[made], self.rank[made] = pair, rank
            spelled[inner(left + right)] = made
        undone = [i for i in self.split if self.rank[i] >= 0]
        if undone != sorted(undone) or min(undone, default=0) < max(i for i in self.split if self.rank[i] < 0):
            raise ValueError("ids must follow the order of merges, after the bytes")
        self.length = {i: len(t) for t, i in spelled.items()}
        self.shorter = {i: next((spelled[t[:n]] for n in range(len(t) - 1, 0, -1) if t[:n] in spelled), None) for t, i in spelled.items()}
        self.automaton = ahocorasick.Automaton()
        for token, i in spelled.items():
            self.automaton.add_word(token, (len(token), i))
        self.automaton.make_automaton()
        self.compatible: dict[int, bool] = {}  # a number takes half the memory of a pair

    def fits(self, left: int, right: int) -> bool:
        """Whether merging leaves the border between two tokens open."""
        key = left << 32 | right
        known = self.compatible.get(key)
        if known is None:
            if len(self.compatible) >= PAIRS:
                self.compatible.clear()
            known = self.compatible[key] = self._fits(left, right)
        return known

    def _fits(self, left: int, right: int) -> bool:
        """Undo the later merge of the two, again and again, and see whether an earlier one would have crossed the border.

        ``limit`` is the merge undone last: only one before it could have come
        first. Ids of base tokens come before all merges and cannot be undone.
        """
        split, joined = self.split, self.joined
        limit = 1 << 62
        while True:
            across = joined.get((left, right))
            if across is not None and across < limit:
                return False
            left_base, right_base = split[left][0] == left, split[right][0] == right
            if left_base and right_base:
                return True
            if right_base or (not left_base and left > right):
                limit, left = left, split[left][1]
            else:
                limit, right = right + 1, split[right][0]

    def word(self, letters: str) -> list[int]:
        """Ids of a word spelled in the byte alphabet."""
        text = letters + END if self.suffix else letters
        size = len(text)
        longest = [0] * size
        token_at: list[int | None] = [None] * size
        for end, (length, token) in self.automaton.iter(text):
            start = end + 1 - length
            if length > longest[start]:
                longest[start], token_at[start] = length, token
        open_end = bytearray(b"\1") * (size + 1)
        made: list[int] = []
        at, token = 0, token_at[0] if size else None
        while at < size:
            while token is not None:
                end = at + self.length[token]
                if open_end[end] and (not made or self.fits(made[-1], token)):
                    break
                token = self.shorter[token]
            if token is None:
                open_end[at] = 0
                token = made.pop()
                at -= self.length[token]
                token = self.shorter[token]
                continue
            made.append(token)
            at = end
            token = token_at[at] if at < size else None
        return made


class WordTokenizer:
    """A tokenizer file with word ends: NFC, white space dropped, lower case, byte-level pairs; decoding joins tokens by a space."""

    def __init__(self, path: str, kept: int = KEPT) -> None:
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        self.pairs = PairEncoder(model["vocab"], merges, model["end_of_word_suffix"] or "")
        self.added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.special = re.compile("(" + "|".join(re.escape(t) for t in sorted(self.added, key=len, reverse=True)) + ")")
        self.words = regex.compile(spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"])
        self.normalizer, self.pre_tokenizer = (lambda t: (t.normalizer, t.pre_tokenizer))(Tokenizer.from_file(path))
        self.chunk = re.compile(f"[^{SPACE}]+")
        self.known = ChunkIds(self._chunk, kept)
        tokens = {**{i: t for t, i in model["vocab"].items()}, **{i: t for t, i in self.added.items()}}
        size = max(tokens) + 1
        self.spelled = self._table([tokens.get(i, "").encode() + b" " for i in range(size)])
        self.decimal = self._table([b"%d " % i for i in range(size)])

    @staticmethod
    def _table(entries: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """All entries one after the other, and where each begins."""
        return np.frombuffer(b"".join(entries), np.uint8), np.cumsum([0, *map(len, entries)])

    def _chunk(self, chunk: str) -> bytes:
        """Where tables of Unicode may differ in age, the file's own normaliser and pre-tokenizer cut the chunk."""
        if chunk.isascii():
            words = [w.translate(self.pairs.letters) for w in self.words.findall(chunk.lower())]
        elif max(chunk) < SETTLED:
            text = unicodedata.normalize("NFC", chunk).replace("Σ", "σ").lower()
            words = [w.encode().decode("latin-1").translate(self.pairs.letters) for w in self.words.findall(text)]
        else:
            words = [w for w, _ in self.pre_tokenizer.pre_tokenize_str(self.normalizer.normalize_str(chunk))]
        made: list[int] = []
        for word in words:
            made += self.pairs.word(word)
        return np.array(made, "<u4").tobytes()

    def encode(self, texts: list[str]) -> list[bytes]:
        """Little-endian 32-bit ids of each text; an added token is found in the text as it stands."""
        return [self._text(t) for t in texts]

    def _text(self, text: str) -> bytes:
        if not any(a in text for a in self.added):
            return self.known.of_text(text, self.chunk)
        parts = self.special.split(text)
        return b"".join(
            np.array([self.added[p]], "<u4").tobytes() if i % 2 else self.known.of_text(p, self.chunk) for i, p in enumerate(parts)
        )

    @staticmethod
    def _gather(table: tuple[np.ndarray, np.ndarray], ids: np.ndarray):
        """The entries of all ids, joined, some ids at a time."""
        data, begin = table
        for at in range(0, len(ids), SLICE):
            part = ids[at : at + SLICE]
            sizes = begin[part + 1] - begin[part]
            ends = np.cumsum(sizes)
            yield data[np.repeat(begin[part] - ends + sizes, sizes) + np.arange(ends[-1])].tobytes()

    def decode(self, ids: np.ndarray) -> str:
        return b"".join(self._gather(self.spelled, ids.astype(np.int64)))[:-1].decode("utf-8")

    def digest(self, ids: np.ndarray, decoded: bool) -> str:
        """SHA-256 of the decoded text, or of the ids in decimal; both joined by a space, without one at the end."""
        digest, held = hashlib.sha256(), b""
        for part in self._gather(self.spelled if decoded else self.decimal, ids.astype(np.int64)):
            digest.update(held)
            held = part
        digest.update(held[:-1])
        return digest.hexdigest()


@lru_cache(maxsize=2)
def _tokenizer(path: str, kept: int = KEPT) -> WordTokenizer:
    return WordTokenizer(path, kept)


def _blocks(docs: DataFrame, work, schema: str, id_column: str, text_column: str) -> DataFrame:
    rows = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).cast("string").alias("text"))
    return arrow_rows(rows, work, schema)


def encode_documents(docs: DataFrame, tokenizer: str, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``doc_id, ids`` per row. Null texts count as empty; ids of rows, null or repeated, are passed through."""

    def work(block: dict[str, list]) -> dict[str, list]:
        coded = _tokenizer(tokenizer).encode([t or "" for t in block["text"]])
        return {"doc_id": block["doc_id"], "ids": [np.frombuffer(c, "<u4").astype(np.int32) for c in coded]}

    return _blocks(docs, work, "doc_id long, ids array<int>", id_column, text_column)


def decode_documents(coded: DataFrame, tokenizer: str) -> DataFrame:
    """``doc_id, text`` from ``doc_id, ids``; null ids decode to the empty text."""

    def work(block: dict[str, list]) -> dict[str, list]:
        decode = _tokenizer(tokenizer).decode
        return {"doc_id": block["doc_id"], "text": [decode(np.array(i or [], np.int64)) for i in block["ids"]]}

    return arrow_rows(coded.select("doc_id", "ids"), work, "doc_id long, text string")


def round_trip_digests(docs: DataFrame, tokenizer: str, id_column: str = "doc_id", text_column: str = "text", keep_ids: bool = False, kept: int = KEPT) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` per row, and with ``keep_ids`` the ``ids``.

    The hashes are of the ids in decimal, joined by a space, and of the decoded
    text. Decoded texts do not leave the task. A Python worker keeps the ids of
    up to twice ``kept`` chunks, which cost memory and spare time.
    """

    def work(block: dict[str, list]) -> dict[str, list]:
        words = _tokenizer(tokenizer, kept)
        coded = [np.frombuffer(c, "<u4") for c in words.encode([t or "" for t in block["text"]])]
        return {
            "doc_id": block["doc_id"],
            "n_tokens": [len(c) for c in coded],
            "ids_sha256": [words.digest(c, decoded=False) for c in coded],
            "decoded_sha256": [words.digest(c, decoded=True) for c in coded],
            **({"ids": [c.astype(np.int32) for c in coded]} if keep_ids else {}),
        }

    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * keep_ids
    return _blocks(docs, work, schema, id_column, text_column)
