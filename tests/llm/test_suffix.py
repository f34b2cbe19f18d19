from __future__ import annotations

import hashlib
import random
import tracemalloc
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from skylog.llm import suffix_dedup
from skylog.llm.suffix_groups import common_prefixes, suffix_arrays


def shared(a, b):
    n = 0
    while n < min(len(a), len(b)) and a[n] == b[n]:
        n += 1
    return n


@settings(max_examples=150, deadline=None)
@given(st.lists(st.one_of(st.lists(st.integers(1, 3), max_size=40), st.builds(lambda p, n: (p * 60)[:n], st.lists(st.integers(1, 4), min_size=1, max_size=5), st.integers(0, 60))), min_size=1, max_size=6))
def test_suffix_arrays_and_common_prefixes(texts):
    texts = [[*t, 0] for t in texts]
    flat, sizes = np.array(sum(texts, []), np.uint16), [len(t) for t in texts]
    ordered = suffix_arrays(flat, sizes)
    common = common_prefixes(flat, sizes, ordered)
    at = 0
    for text in texts:
        expected = sorted(range(len(text)), key=lambda i: text[i:])
        assert (ordered[at : at + len(text)] - at).tolist() == expected
        assert common[at + 1 : at + len(text)].tolist() == [shared(text[i:], text[j:]) for i, j in zip(expected, expected[1:])]
        at += len(text)


def truth(rows, length):
    """Every string of that length counted, byte by byte."""
    texts = [(i, (t or "").encode()) for i, t in rows]
    counts = Counter(t[k : k + length] for _, t in texts for k in range(len(t) - length + 1))
    made = []
    for i, text in texts:
        gone = np.zeros(len(text) + 1, bool)
        for k in range(len(text) - length + 1):
            if counts[text[k : k + length]] > 1:
                gone[k : k + length] = True
        kept = bytes(b for b, g in zip(text, gone) if not g)
        made.append((i, len(text), int(gone.sum()), int((gone[:-1] < gone[1:]).sum() + gone[0]), hashlib.sha256(kept).hexdigest()))
    return sorted(made, key=str)


def lines(frame, length=400):
    return sorted((tuple(r) for r in suffix_dedup.remove_repeats(frame, length).collect()), key=str)


SCHEMA = "doc_id long, text string, key string, copies int, runs string"


@pytest.fixture(scope="module")
def rows():
    """Passages shared by many texts at and around the length, periodic and uniform texts, copies, and edge rows."""
    rnd = random.Random(5)
    words = ["alpha", "béta", "gamma", "delta", "épsilon", "zeta", "eta", "theta", "iota", "kappa"]
    prose = lambda n: " ".join(rnd.choice(words) + str(rnd.randrange(1000)) for _ in range(n))
    passage = prose(90)
    made = [prose(rnd.randrange(1, 60)) + passage[: rnd.choice([395, 399, 400, 401, 450, 700])] + prose(rnd.randrange(1, 60)) for _ in range(70)]
    made += [prose(80)] * 3 + [passage, "a" * 399, "a" * 400, "b" * 401, "lorem ipsum " * 300, "", " ", "short", prose(400) + "z" * 900]
    made += [made[0] + made[0][: 300], passage[50:] + passage[:500]]
    return [(i, t) for i, t in enumerate(made)] + [(None, passage), (3, "repeated id"), (4, None)]


@pytest.mark.parametrize("crowd, share", [(32, 1000), (1, 1000), (2, 1)])
def test_removed_bytes_are_those_of_all_strings(spark, rows, monkeypatch, crowd, share):
    """With small crowds keys are cut into cells; with a low share nothing counts as heavy."""
    monkeypatch.setattr(suffix_dedup, "CROWD", crowd)
    monkeypatch.setattr(suffix_dedup, "SHARE", share)
    frame = spark.createDataFrame([(i, t, "x", 1, "y") for i, t in rows], SCHEMA).repartition(3)
    got = lines(frame)
    assert got == truth(rows, 400)
    assert sum(r[2] > 0 for r in got) > 50


def test_other_lengths_and_pieces(spark, rows, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "PIECE", 1000)
    suffix_dedup._powers.cache_clear()
    frame = spark.createDataFrame([(i, t, "x", 1, "y") for i, t in rows], SCHEMA)
    assert lines(frame, 500) == truth(rows, 500)
    with pytest.raises(ValueError, match="between 337"):
        suffix_dedup.remove_repeats(frame, 100)


def test_empty_table(spark, nothing):
    assert lines(nothing) == []


def test_documents(spark, documents):
    assert lines(documents) == truth([(r.doc_id, r.text) for r in documents.collect()], 400)


def test_a_piece_takes_little_memory():
    rng = np.random.default_rng(2)
    pair = [rng.integers(97, 123, 500).astype(np.uint8).tobytes() for _ in range(2)]
    groups = [pair] * (suffix_dedup.PIECE // 1000)

    def peak(work) -> int:
        tracemalloc.start()
        work()
        most = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        return most

    # Six tasks of an executor share about a gigabyte beside the heap.
    assert peak(lambda: suffix_dedup.shared_starts(groups, 400)) < 60 << 20
    assert peak(lambda: suffix_dedup._anchors(np.frombuffer(b"".join(map(b"".join, groups)), np.uint8), 400, suffix_dedup.ANCHOR)) < 60 << 20
