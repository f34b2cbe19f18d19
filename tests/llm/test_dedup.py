from __future__ import annotations

import math
import tracemalloc
from collections import defaultdict

import numpy as np
import pytest

from skylog.llm import exact_dedup, probminhash, shingles
from skylog.llm.components import block_pairs, components


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def test_exact_groups(spark, edge):
    lines = exact_dedup.exact_dedup(edge).collect()
    assert len(lines) == 10
    by_id = defaultdict(list)
    for r in lines:
        by_id[r.doc_id].append((r.keep_id, r.group_size, r.kept))
    assert by_id[7] == [(7, 3, True)] and by_id[3] == [(7, 3, False)] and by_id[None] == [(7, 3, False)]
    assert by_id[9] == [(9, 2, True)] and by_id[1] == [(9, 2, False)]  # null counts as empty
    assert sorted(by_id[5]) == [(5, 2, False), (5, 2, True)]  # of a repeated row one stays
    other = edge.selectExpr("*", "1 AS _dedup_id", "2 AS _DEDUP_KEPT", "3 AS _place", "4 AS _lines", "5 AS _right__dedup_id_")
    other = exact_dedup.drop_duplicates(other)
    assert len(other.columns) == len(edge.columns) + 5 and {tuple(r[-5:]) for r in other.collect()} == {(1, 2, 3, 4, 5)}
    kept = exact_dedup.drop_duplicates(edge)
    assert kept.columns == edge.columns
    assert sorted(r.doc_id for r in kept.collect()) == [2, 4, 5, 6, 7, 9]


def test_exact_on_an_empty_table(nothing):
    assert exact_dedup.exact_dedup(nothing).count() == 0
    assert exact_dedup.drop_duplicates(nothing).count() == 0


@pytest.mark.parametrize("counters, winners", [(16, 4), (1024, 512)])
def test_exact_with_a_heavy_text(spark, counters, winners):
    """A third of all rows alike, and so many others that the counters run out."""
    docs = spark.range(3000).selectExpr("id AS doc_id", "CASE WHEN id % 3 = 0 THEN 'Same' WHEN id % 7 = 0 THEN 'pair ' || floor(id / 14) ELSE 'own ' || id END AS text")
    texts = defaultdict(list)
    for r in docs.collect():
        texts[lower(r.text)].append(r.doc_id)
    for r in exact_dedup.exact_dedup(docs, counters=counters, winners=winners).collect():
        group = next(g for g in texts.values() if r.doc_id in g)
        assert (r.keep_id, r.group_size, r.kept) == (max(group), len(group), r.doc_id == max(group))


def test_frequent_digest_is_found_and_never_shuffled(spark):
    rows = spark.range(9000).selectExpr("CASE WHEN id % 3 = 0 THEN unhex('00') ELSE cast(cast(id AS string) AS binary) END AS digest")
    found = {r.hash for r in exact_dedup.frequent_digests(rows, 64, 8).collect()}
    assert rows.where("digest = unhex('00')").selectExpr("xxhash64(digest) AS h").first().h in found and len(found) <= 8


def set_truth(docs, threshold=0.8):
    """Every pair compared: the smallest id that links reach, per document."""
    sets = {}
    for i, text in docs:
        owner, shingle, weight = shingles.weighted_shingles([shingles.prepared(text)])
        sets[i] = (shingle, weight)
    low = {i: i for i in sets}

    def find(i):
        while low[i] != i:
            i = low[i]
        return i

    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[:n]:
            if len(np.intersect1d(sets[a][0], sets[b][0])) and shingles.probability_jaccard(sets[a], sets[b]) >= threshold - 1e-12:
                x, y = find(a), find(b)
                low[max(x, y)] = min(x, y)
    return {i: find(i) for i in ids}


def test_near_groups_are_those_of_all_pairs(spark, documents):
    words = [f"w{i}" for i in range(90)]
    made = [(10_000 + k, " ".join(words[:k] + [f"new{k}"] + words[k + 1 :])) for k in range(0, 80, 4)]
    made += [(20_000, " ".join(words)), (20_001, " ".join(words).upper()), (20_002, "a few words"), (20_003, "a few words more")]
    docs = documents.select("doc_id", "text").unionByName(spark.createDataFrame(made, "doc_id long, text string"))
    truth = set_truth([(r.doc_id, r.text) for r in docs.collect()])
    got = {r.doc_id: r.cluster_id for r in probminhash.near_duplicates(docs).collect()}
    assert got == truth


def test_the_filter_before_the_verification_loses_less_than_the_bands():
    fewest = math.ceil(probminhash.MAYBE * probminhash.SIZE)
    missed = sum(math.comb(probminhash.SIZE, k) * 0.8**k * 0.2 ** (probminhash.SIZE - k) for k in range(fewest))
    no_band = (1 - 0.8**probminhash.ROWS) ** (probminhash.SIZE // probminhash.ROWS)
    assert missed < no_band / 1e6


def test_near_edge_cases(edge, nothing):
    lines = {r.doc_id: r for r in probminhash.near_duplicates(edge).collect()}
    assert len(lines) == 9 and probminhash.near_duplicates(edge).count() == 10
    assert lines[7].cluster_id == 3 and not lines[7].kept and lines[3].kept
    assert lines[None].kept and lines[None].cluster_id is None
    assert all(lines[i].kept and lines[i].cluster_id == i for i in (9, 1, 2, 5, 6, 4))
    kept = probminhash.one_of_each(edge)
    assert kept.columns == edge.columns and kept.count() == 9
    assert probminhash.near_duplicates(nothing).count() == 0


def brute_similarity(a, b):
    shared = set(a) & set(b)
    every = set(a) | set(b)
    return sum(1 / sum(max(a.get(e, 0) / a[d], b.get(e, 0) / b[d]) for e in every) for d in shared)


def test_probability_jaccard_is_its_definition():
    rng = np.random.default_rng(5)
    for _ in range(50):
        a = {int(k): float(w) for k, w in zip(rng.choice(30, 12, replace=False), rng.integers(1, 5, 12))}
        b = {int(k): float(w) for k, w in zip(rng.choice(30, 9, replace=False), rng.integers(1, 5, 9))}
        sets = [(np.array(sorted(s), np.uint64), np.array([s[k] for k in sorted(s)])) for s in (a, b)]
        assert shingles.probability_jaccard(*sets) == pytest.approx(brute_similarity(a, b))


def test_signatures_estimate_the_similarity():
    texts = [shingles.prepared(" ".join(f"t{i}" for i in r)) for r in (range(300), range(40, 340), range(1000, 1010))]
    owner, shingle, weight = shingles.weighted_shingles(texts)
    sets = [(shingle[owner == i], weight[owner == i]) for i in range(3)]
    signature = probminhash.signatures(owner, shingle, weight, 3)
    assert (signature != 0).all()  # every component is reached, by short texts too
    assert (signature[0] == signature[1]).mean() == pytest.approx(shingles.probability_jaccard(sets[0], sets[1]), abs=0.1)
    assert (signature[0] == signature[2]).sum() == 0


def test_word_hashes_do_not_depend_on_the_place(monkeypatch):
    text = " ".join(f"wörd{i % 50}" for i in range(2000)).encode()
    whole, counts = shingles.word_hashes([b"", text, b"  ", text])
    monkeypatch.setattr(shingles, "PIECE", 97)
    pieces, again = shingles.word_hashes([b"", text, b"  ", text])
    assert counts.tolist() == again.tolist() == [0, 2000, 0, 2000]
    assert (whole == pieces).all() and (whole[:2000] == whole[2000:]).all() and len(set(whole.tolist())) == 50


def test_components(spark):
    chain = [(i, i + 1) for i in range(100, 160)] + [(1, 9), (9, 4), (4, 4), (7, None), (2, 3), (3, 2)]
    got = {r.node: r.component for r in components(spark.createDataFrame(chain, "a long, b long")).collect()}
    assert got == {**{i: 100 for i in range(100, 161)}, 1: 1, 9: 1, 4: 1, 2: 2, 3: 2}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_block_pairs_bring_every_pair_together_once(spark):
    rows = spark.range(50).selectExpr("id", "CASE WHEN id < 40 THEN 1 ELSE 2 END AS g")
    met = defaultdict(int)
    groups = defaultdict(list)
    for r in block_pairs(rows, ["g"], "id", 8).collect():
        groups[(r.g, r.i, r.j)].append((r.id, r.side))
    for (_, i, j), members in groups.items():
        for n, (a, x) in enumerate(members):
            for b, y in members[:n]:
                met[tuple(sorted((a, b)))] += i == j or x != y
    assert all(met[(a, b)] == 1 for a in range(40) for b in range(a + 1, 40))
    assert all(met[(a, b)] == 1 for a in range(40, 50) for b in range(a + 1, 50))


def test_hashes_of_words_take_little_memory():
    texts = [b"some words of a text that goes on" * 1000] * 64
    shingles._powers.clear()
    tracemalloc.start()
    shingles.word_hashes(texts)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    # A worker keeps the tables, and the rest of its life goes on beside them.
    assert most < 40 << 20
    assert sum(t.nbytes for t in shingles._powers) < 5 << 20
