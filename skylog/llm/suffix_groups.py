"""Suffix arrays by linear grouping, for many short texts side by side.

Suffixes are grouped by their Lyndon prefix. The groups of a text are taken from
the highest to the lowest. The members of the one at hand point to the nearest
suffix on their left that belongs to a lower group: their previous smaller one.
Suffixes that are pointed to move into a new group behind their own, the higher
the more members point to them. As a group leaves the row of open suffixes when
it has been taken, that pointer is always the left neighbour in the row, so that
all pointers together cost time in proportion to the text.

Then suffixes come out from the lowest up. Each puts those whose Lyndon prefix
ends where it begins next in line within their groups. Nothing is renamed and
nothing recurses.

All texts take a step at the same time, so that numpy works on as many groups as
there are texts.
"""

from __future__ import annotations

import numpy as np


def _spread(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """``starts[i], starts[i] + 1, ...``, ``counts[i]`` of them, for every i."""
    before = np.cumsum(counts) - counts
    return np.repeat(starts - before, counts) + np.arange(counts.sum())


def _first_groups(text: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions by text and symbol, and where each run of equal symbols of a text begins."""
    owner = np.repeat(np.arange(len(starts), dtype=np.uint32), sizes)
    rows = np.argsort(text, kind="stable")
    rows = rows[np.argsort(owner[rows], kind="stable")]
    change = np.flatnonzero(np.append(True, (text[rows][1:] != text[rows][:-1]) | (owner[rows][1:] != owner[rows][:-1])))
    group = np.empty(len(text), np.int64)
    group[rows] = np.repeat(change, np.diff(np.append(change, len(text))))
    return rows, group


def lyndon_groups(text: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of every suffix, where its group begins in the suffix array, and the length of its Lyndon prefix."""
    n = len(text)
    none = n  # beyond either end of a text
    rows, group = _first_groups(text, starts, sizes)
    at = np.empty(n, np.int64)
    at[rows] = np.arange(n)
    size = np.bincount(group, minlength=n)
    prefix = np.ones(n, np.int64)
    left, right = np.arange(-1, n), np.arange(1, n + 2)
    left[starts], right[starts + sizes - 1] = none, none
    left[none] = right[none] = none
    jump = np.empty(n + 1, np.int64)
    inside = np.zeros(n + 1, bool)
    pointed = np.zeros(n + 1, np.int64)
    seen = np.empty(n + 1, np.int64)

    def neighbour(members: np.ndarray, links: np.ndarray) -> np.ndarray:
        """The nearest open suffix outside the group; runs of members are crossed by doubling."""
        near = links[members]
        crossing = inside[near]
        if crossing.any():
            jump[members] = near
            while crossing.any():
                near[crossing] = jump[near[crossing]]
                jump[members] = near
                crossing = inside[near]
        return near

    low, end = starts.copy(), starts + sizes
    while True:
        going = end - low > 1  # the end mark of a text is its lowest group
        if not going.all():
            low, end = low[going], end[going]
        if not len(low):
            return group, prefix
        top = rows[end - 1]
        begin = group[top]
        counts = end - begin
        members = rows[_spread(begin, counts)]
        length = np.repeat(prefix[top], counts)
        inside[members] = True
        previous, following = neighbour(members, left), neighbour(members, right)
        inside[members] = False
        right[previous], left[following] = following, previous
        left[none] = right[none] = none
        end = begin

        real = previous < none
        previous, length = previous[real], length[real]
        if not len(previous):
            continue
        np.add.at(pointed, previous, 1)
        each = np.arange(len(previous))
        seen[previous] = each
        once = seen[previous] == each
        moved, length = previous[once], length[once]
        times = pointed[moved]
        pointed[moved] = 0
        prefix[moved] += times * length

        key = (group[moved] << 24) + times
        order = np.argsort(key)
        moved, key = moved[order], key[order]
        old = group[moved]
        first = np.flatnonzero(np.append(True, old[1:] != old[:-1]))
        many = np.diff(np.append(first, len(old)))
        tail = old[first] + size[old[first]] - many
        slot = _spread(tail, many)
        inside[moved] = True
        held = rows[slot]
        staying = held[~inside[held]]
        inside[moved] = False
        place = at[moved]
        freed = place[place < np.repeat(tail, many)]
        rows[freed], at[staying] = staying, freed
        rows[slot], at[moved] = moved, slot
        size[old[first]] -= many
        new = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
        lengths = np.diff(np.append(new, len(key)))
        size[slot[new]] = lengths
        group[moved] = np.repeat(slot[new], lengths)


def suffix_arrays(text: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Positions of all suffixes in ascending order, text by text.

    ``text`` holds texts one after the other, as small unsigned integers; each
    ends with a 0 that it has nowhere else. ``sizes`` are their lengths, that
    mark included.
    """
    n, sizes = len(text), np.asarray(sizes, np.int64)
    starts = np.cumsum(sizes) - sizes
    group, prefix = lyndon_groups(text, starts, sizes)
    # What a suffix places: those whose Lyndon prefix ends where it begins.
    mark = starts + sizes - 1
    follows = np.arange(n) + prefix
    follows[mark] = n
    children = np.argsort(follows, kind="stable")
    counts = np.bincount(follows, minlength=n + 1)
    first = np.cumsum(counts) - counts
    ordered = np.empty(n, np.int64)
    ordered[starts] = mark
    free = np.arange(n)
    longest = np.argsort(-sizes, kind="stable")
    at, left = starts[longest], sizes[longest]
    for step in range(int(left[0]) if len(left) else 0):
        if left[-1] <= step:
            going = np.searchsorted(-left, -step, "left")
            at, left = at[:going], left[:going]
        here = ordered[at + step]
        placed = children[_spread(first[here], counts[here])]
        home = group[placed]
        slot = free[home]
        free[home] = slot + 1
        ordered[slot] = placed
    return ordered


def common_prefixes(text: np.ndarray, sizes: np.ndarray, ordered: np.ndarray) -> np.ndarray:
    """How many symbols each entry of the suffix arrays shares with the one before it in its text; 0 for the first.

    Where the symbols before both are equal too, the length is one less than that
    of the suffix one to the left. Only the others are compared.
    """
    n, sizes = len(text), np.asarray(sizes, np.int64)
    starts = np.cumsum(sizes) - sizes
    beside = np.empty(n, np.int64)
    beside[ordered[1:]] = ordered[:-1]
    beside[ordered[starts]] = -1
    own = np.arange(n)
    known = beside >= 0
    before = np.maximum(beside - 1, 0)
    open_left = np.ones(n, bool)
    open_left[starts] = False
    reducible = known & open_left & (text[np.maximum(own - 1, 0)] == text[before])
    begins = np.zeros(n, bool)
    begins[starts] = True
    reducible &= ~begins[np.maximum(beside, 0)]

    padded = np.concatenate([text.astype(np.uint64), np.zeros(4, np.uint64)])
    word = padded[:n] | padded[1 : n + 1] << np.uint64(16) | padded[2 : n + 2] << np.uint64(32) | padded[3 : n + 3] << np.uint64(48)
    shared = np.zeros(n, np.int64)
    a = np.flatnonzero(known & ~reducible)
    b = beside[a]
    who = a
    while len(who):
        differ = word[a] ^ word[b]
        equal = differ == 0
        stop = differ[~equal]
        low = (stop & np.uint64(0xFFFF) == 0).astype(np.int64)
        low += low * (stop & np.uint64(0xFFFFFFFF) == 0)
        low += (low == 2) * (stop & np.uint64(0xFFFFFFFFFFFF) == 0)
        shared[who[~equal]] += low
        who, a, b = who[equal], a[equal] + 4, b[equal] + 4
        shared[who] += 4
        # The end mark differs from all else, so that no pair runs beyond its text.
    compared = np.maximum.accumulate(np.where(reducible, -1, own))
    shared = np.where(reducible, shared[compared] - (own - compared), shared)
    return shared[ordered]
