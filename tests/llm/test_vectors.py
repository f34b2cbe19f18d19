from __future__ import annotations

import re

import numpy as np
import pytest

from skylog.llm import vector_forest

SCHEMA = "vec_id long, embedding array<float>, label int, node string, id long, root int"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, label, "n", 0, 1) for i, v, label in rows], SCHEMA)


def truth(rows):
    """Every pair of a label: number of links, and the smallest id they reach."""
    ids = [r[0] for r in rows]
    x = np.array([r[1] for r in rows], np.float32).astype(float)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    label = np.array([r[2] for r in rows])
    near = (x @ x.T >= 0.98) & (label[:, None] == label[None, :])
    np.fill_diagonal(near, False)
    low = np.array(ids)
    while True:
        after = np.minimum(low, np.where(near, low[None, :], 1 << 40).min(axis=1))
        if (after == low).all():
            return {i: (int(n), int(c)) for i, n, c in zip(ids, near.sum(axis=1), low)}
        low = after


def made(seed=3):
    """Random vectors of two labels, chains of slowly turning ones, and a dense bunch."""
    rng = np.random.default_rng(seed)
    rows = [rng.standard_normal(32) for _ in range(500)]
    for _ in range(20):
        a, b = rng.standard_normal(32), rng.standard_normal(32)
        rows += [a * np.cos(t) + b * np.sin(t) for t in np.arange(8) * 0.15]
    centre = rng.standard_normal(32)
    rows += [centre + 0.05 * rng.standard_normal(32) for _ in range(250)]
    order = rng.permutation(len(rows))
    return [(int(i) + 1, [float(c) for c in v], int(i) % 2) for i, v in zip(order, rows)]


@pytest.mark.parametrize("node_rows", [4096, 120])
def test_links_and_components_are_those_of_all_pairs(spark, node_rows, monkeypatch):
    """With small nodes the forest is split on the cluster, and the dense bunch goes block against block."""
    monkeypatch.setattr(vector_forest, "BLOCK", 64)
    rows = made()
    got = vector_forest.near_vectors(frame(spark, rows), node_rows=node_rows).collect()
    expected = truth(rows)
    assert {r.vec_id: (r.n_links, r.component_id) for r in got} == expected
    assert all(r.kept == (r.vec_id == r.component_id) for r in got)
    assert sum(n for n, _ in expected.values()) > 20_000


def test_edge_cases(spark):
    rows = [
        (1, [1.0, 0.0], 1), (2, [2.0, 0.0], 1), (3, [1.0, 0.0], 1), (3, [1.0, 0.0], 1),  # a repeated row counts once
        (4, [1.0, 0.0], 2), (5, [1.0, 0.0], None), (6, None, 1), (7, [0.0, 0.0], 1), (8, [1.0, None], 1),
        (9, [1.0, float("nan")], 1), (10, [float("inf"), 1.0], 1), (11, [], 1), (None, [1.0, 0.0], 1), (12, [1.0, 0.0, 0.0], 1),
    ]
    got = [(r.vec_id, r.n_links, r.component_id, r.kept) for r in vector_forest.near_vectors(frame(spark, rows)).collect()]
    assert sorted(g for g in got if g[0] in (1, 2, 3)) == [(1, 2, 1, True), (2, 2, 1, False), (3, 2, 1, False), (3, 2, 1, False)]
    assert sorted(g for g in got if g[0] and g[0] > 3) == [(i, 0, i, True) for i in range(4, 13)]
    assert [g for g in got if g[0] is None] == [(None, 0, None, True)]


def test_empty_table(spark):
    assert vector_forest.near_vectors(frame(spark, [])).count() == 0


def test_recall_of_single_trees(spark):
    """One tree may part a pair; the forest has at least nine tenths of all components' members by far."""
    rows = made(8)
    expected = truth(rows)
    got = {r.vec_id: r.component_id for r in vector_forest.near_vectors(frame(spark, rows), trees=1).collect()}
    linked = [i for i, (n, _) in expected.items() if n]
    assert sum(got[i] == expected[i][1] for i in linked) >= 0.9 * len(linked)


def test_planted_links_where_nodes_are_split_on_the_cluster(spark):
    """20,000 vectors of one label in 64 dimensions, nodes of the usual size: pairs, chains and a crowd among them."""
    rng = np.random.default_rng(11)
    x = rng.standard_normal((20_000, 64))
    x[1000:1500] = x[:500] + 0.12 * rng.standard_normal((500, 64))
    for start in range(2000, 3000, 10):
        a, b = x[start].copy(), x[start + 1].copy()
        x[start : start + 10] = [a * np.cos(t) + b * np.sin(t) for t in np.arange(10) * 0.12]
    x[4000:7000] = x[4000] + 0.1 * rng.standard_normal((3000, 64))
    rows = [(i, [float(c) for c in v], 7) for i, v in enumerate(x.astype(np.float32))]
    expected = truth(rows)
    got = {r.vec_id: (r.n_links, r.component_id) for r in vector_forest.near_vectors(frame(spark, rows)).collect()}
    linked = [i for i, (n, _) in expected.items() if n]
    right = sum(got[i] == expected[i] for i in linked)
    print("linked", len(linked), "right", right)
    assert len(linked) > 4000 and right >= 0.99 * len(linked)
    assert all(got[i] == expected[i] for i in expected if not expected[i][0])


def test_blocks_of_a_component_part_again(spark):
    members = spark.range(10).selectExpr("id DIV 10 + 1 AS component", "id", "1L AS copies", "array(1.0D, cast(id AS double)) AS vector")
    plan = vector_forest._link_counts(members)._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"Exchange hashpartitioning\(component#\d+L, i#\d+, j#\d+, \d+\), REPARTITION_BY_COL", plan)
