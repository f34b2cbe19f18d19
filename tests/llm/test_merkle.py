from __future__ import annotations

import hashlib
import zlib
from itertools import groupby

import pytest

from skylog.llm import merkle


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row, added=0):
    doc_id, source, lang, n_chars, text = row
    values = (doc_id, source, lang, None if n_chars is None else n_chars + added, text)
    return h(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in values])


def tree(nodes):
    """Levels from the leaves to the one that is left."""
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([h(*levels[-1][i : i + 2]) for i in range(0, len(levels[-1]), 2)])
    return levels


def beside(levels, place):
    return [(place >> k) % 2 and (level[(place >> k) - 1], "L") or ("".join(level[(place >> k) + 1 : (place >> k) + 2]), "R") for k, level in enumerate(levels[:-1])]


def truth(rows):
    """The manifest of ``doc_id, source, lang, n_chars, text``, node by node."""
    order = lambda r: ((r[2] is not None, (r[2] or "").encode()), (r[0] is not None, r[0] or 0), leaf(r))
    lanes = [list(g) for _, g in groupby(sorted(rows, key=order), key=lambda r: r[2])]
    trees = [tree([leaf(r) for r in lane]) for lane in lanes]
    top = tree([t[-1][0] for t in trees])
    made = []
    for n, (lane, levels) in enumerate(zip(lanes, trees)):
        for place, row in enumerate(lane):
            path = beside(levels, place) + beside(top, n)
            node = leaf(row, row[0] is not None and zlib.crc32(str(row[0]).encode()) % 7 == 0)
            for sibling, side in path:
                node = h(sibling, node) if side == "L" else h(node, sibling)
            made.append((row[0], leaf(row), levels[-1][0], top[-1][0], h(*[s for s, _ in path]), node, node == top[-1][0]))
    return made


SCHEMA = "doc_id long, source string, lang string, n_chars long, text string, lane string, pos long, digest string, path string"


def check(spark, rows):
    docs = spark.createDataFrame([(*r, "x", 5, "y", "z") for r in rows], SCHEMA).repartition(3)
    got = [tuple(r) for r in merkle.manifest(docs).collect()]
    assert sorted(got, key=str) == sorted(truth(rows), key=str)
    return got


def test_edge_rows(spark):
    rows = [(7, "a", "en", 3, "abc"), (3, None, "en", None, None), (9, "", "en", 0, ""), (1, "b", None, 2, "é🙂"), (None, "b", "ü", 2**63 - 1, "x" * 300_000)]
    rows += [(5, "b", "de", 1, "y"), (5, "b", "de", 1, "y"), (5, "a", "de", 1, "z"), (None, None, None, None, None), (14, "c", "", 4, "1:-")]
    assert len(check(spark, rows)) == 10
    assert len(check(spark, rows[:1])) == 1
    assert check(spark, []) == []


@pytest.mark.parametrize("height", [2, 8])
def test_blocks_of_many_leaves(spark, monkeypatch, height):
    """Lanes that end within, at and beyond blocks, over several passes; one holds most rows."""
    monkeypatch.setattr(merkle, "HEIGHT", height)
    monkeypatch.setattr(merkle, "BLOCK", 1 << height)
    sizes = {"en": 531, "de": 256, "fr": 257, "a": 1, "b": 2, "c": 16, "d": 17, None: 5}
    rows = [(i * 3, f"s{i % 4}", lang, i, f"text {i}") for lang, n in sizes.items() for i in range(n)]
    got = check(spark, rows)
    assert {r[-1] for r in got} == {True, False}
    assert all(r[-1] != (zlib.crc32(str(r[0]).encode()) % 7 == 0) for r in got)
