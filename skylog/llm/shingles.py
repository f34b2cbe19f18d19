"""Word hashes and word shingles of many texts at once, in numpy.

Words are what stands between ASCII white space, lower-cased. A word's hash is a
polynomial of its bytes: prefix sums over the whole block give every word's at
once, and dividing by the power of its position makes it the same wherever the
word stands.
"""

from __future__ import annotations

import hashlib

import numpy as np

WORDS = 5
# Texts go through in pieces of about this many bytes, cut at white space.
PIECE = 1 << 18

_U = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_powers: list[np.ndarray] = []


def mix(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser: equal bits in, well-spread bits out."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def _power_tables(n: int) -> list[np.ndarray]:
    """Powers of the base and of its inverse, at least n of them; the usual size is kept."""
    if _powers and len(_powers[0]) >= n:
        return _powers
    made = []
    for base in (_BASE, _INVERSE):
        steps = np.full(max(n, PIECE + 4096), base, _U)
        steps[0] = 1
        made.append(np.multiply.accumulate(steps))
    if n <= 4 * PIECE:
        _powers[:] = made
    return made


def _piece_hashes(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and hashes of the words of one piece."""
    gap = np.empty(len(data) + 2, bool)
    gap[0] = gap[-1] = True
    gap[1:-1] = _SPACE[data]
    edges = np.flatnonzero(gap[1:] != gap[:-1])
    starts, ends = edges[0::2], edges[1::2]
    power, inverse = _power_tables(len(data) + 1)
    sums = np.empty(len(data) + 1, _U)
    sums[0] = 0
    np.cumsum((data.astype(_U) + _U(1)) * power[: len(data)], out=sums[1:])
    return starts, mix((sums[ends] - sums[starts]) * inverse[starts])


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words, and the number of words of every text."""
    lengths = np.array([len(t) + 1 for t in texts], np.int64)
    ends = np.cumsum(lengths)
    data = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8) if texts else np.empty(0, np.uint8)
    places, hashes, at = [], [], 0
    while at < len(data):
        stop = min(at + PIECE, len(data))
        while stop < len(data) and not _SPACE[data[stop - 1]]:
            nearby = np.flatnonzero(_SPACE[data[stop : stop + 4096]])
            stop = stop + int(nearby[0]) + 1 if len(nearby) else min(stop + 4096, len(data))
        starts, found = _piece_hashes(data[at:stop])
        places.append(starts + at)
        hashes.append(found)
        at = stop
    place = np.concatenate(places) if places else np.empty(0, np.int64)
    owner = np.searchsorted(ends, place, "right")
    return (np.concatenate(hashes) if hashes else np.empty(0, _U)), np.bincount(owner, minlength=len(texts))


def weighted_shingles(texts: list[bytes], words: int = WORDS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingles with how often they occur, ordered by text and hash: ``text index, hash, weight``.

    A text of fewer words than a shingle has one shingle, of all its words; a
    text without words has none.
    """
    hashes, counts = word_hashes(texts)
    n = len(hashes)
    owner = np.repeat(np.arange(len(texts)), counts)
    first = np.repeat(np.cumsum(counts) - counts, counts)
    left = first + counts[owner] - np.arange(n)  # words from here to the end of the text
    sums = np.zeros(n, _U)
    for k in range(min(words, n)):
        part = hashes[k:] * _U(pow(_BASE, k + 1, 1 << 64))
        sums[: n - k] += np.where(left[: n - k] > k, part, _U(0)) if k else part
    starts = (left >= words) | (np.arange(n) == first)
    short = np.minimum(counts[owner], words).astype(_U)
    owner, sums = owner[starts], mix(sums[starts] + short[starts])
    order = np.lexsort((sums, owner))
    owner, sums = owner[order], sums[order]
    new = np.ones(len(sums), bool)
    new[1:] = (sums[1:] != sums[:-1]) | (owner[1:] != owner[:-1])
    at = np.flatnonzero(new)
    return owner[at], sums[at], np.diff(np.append(at, len(sums))).astype(np.float64)


def prepared(text: str | None) -> bytes:
    return (text or "").lower().encode("utf-8", "surrogatepass")


def words_key(text: bytes) -> bytes:
    """Alike for texts of the same words in the same order."""
    return hashlib.md5(b" ".join(text.split()), usedforsecurity=False).digest()


def probability_jaccard(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Exact probability Jaccard of two weighted sets, each as sorted hashes and weights.

    The sum over shared elements d of 1 / sum over all e of
    max(a(e) / a(d), b(e) / b(d)). Elements are ordered by a(e) / b(e), so that
    which of the two is larger is a place in that order. With weights all alike
    this is the Jaccard similarity.
    """
    (ha, wa), (hb, wb) = a, b
    shared, ia, ib = np.intersect1d(ha, hb, assume_unique=True, return_indices=True)
    if not len(shared):
        return 0.0
    only_a, only_b = wa.sum() - wa[ia].sum(), wb.sum() - wb[ib].sum()
    x, y = wa[ia], wb[ib]
    ratio = x / y
    order = np.argsort(ratio, kind="stable")
    x, y, ratio = x[order], y[order], ratio[order]
    below = np.searchsorted(ratio, ratio, "left")
    sum_x, sum_y = np.concatenate([[0.0], np.cumsum(x)]), np.concatenate([[0.0], np.cumsum(y)])
    total = (only_a + sum_x[-1] - sum_x[below]) + ratio * (only_b + sum_y[below])
    return float((x / total).sum())
