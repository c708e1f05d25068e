"""Links by the forest against all pairs: exact counts where all are found, recall on hard clouds."""

from __future__ import annotations

import math

import numpy as np
import pytest

from meterline.llm import queries, vector_forest


def brute(rows, cosine: float = 0.93) -> dict:
    """row number -> (set of linked rows) over usable vectors of equal label and dimension."""
    use = [
        i for i, (_, v, label) in enumerate(rows)
        if label is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)
    ]
    links = {i: set() for i in range(len(rows))}
    unit = {i: np.array(rows[i][1], dtype=np.float64) / np.abs(np.array(rows[i][1], dtype=np.float64)).max() for i in use}
    unit = {i: u / np.linalg.norm(u) for i, u in unit.items()}
    by: dict = {}
    for i in use:
        by.setdefault((rows[i][2], len(rows[i][1])), []).append(i)
    for group in by.values():
        x = np.stack([unit[i] for i in group])
        for k, row in enumerate(x @ x.T >= cosine):
            links[group[k]] |= {group[j] for j in np.flatnonzero(row).tolist()} - {group[k]}
    return links


def expected(rows, cosine: float = 0.93) -> list[tuple]:
    links, root = brute(rows, cosine), {}
    for i in range(len(rows)):
        if i in root:
            continue
        seen, todo = {i}, [i]
        while todo:
            new = links[todo.pop()] - seen
            seen |= new
            todo += new
        least = min((rows[j][0] for j in seen if rows[j][0] is not None), default=None)
        root.update(dict.fromkeys(seen, least))
    return [(rows[i][0], len(links[i]), root[i], rows[i][0] == root[i]) for i in range(len(rows))]


def key(row):
    return tuple((x is None, x or 0) for x in row)


def table(spark, rows, kind: str = "float"):
    full = [(*r, "x", "y", "z") for r in rows]
    return spark.createDataFrame(full, f"vec_id long, embedding array<{kind}>, label int, node string, code string, row string")


def clouds(rng, dim: int, centres: int, spread: float, alone: int, labels: int = 2) -> list[tuple]:
    """Clouds of unequal sizes around random centres, and vectors of their own."""
    rows = []
    for c in range(centres):
        centre = rng.normal(size=dim)
        centre /= np.linalg.norm(centre)
        for _ in range(int(rng.integers(2, 40))):
            rows.append(centre + rng.normal(size=dim) * spread / np.sqrt(dim))
    rows += list(rng.normal(size=(alone, dim)))
    return [(i, np.float32(v).tolist(), int(rng.integers(labels))) for i, v in enumerate(rows)]


def test_odd_vectors(spark):
    near = [1.0, 0.0, 0.0]
    rows = [
        (1, None, 0), (2, [], 0), (3, [0.0, 0.0, 0.0], 0), (4, [1.0, None, 0.0], 0), (5, [1.0, float("nan"), 0.0], 0), (6, [float("inf"), 0.0, 0.0], 0),
        (7, near, 0), (8, near, 0), (8, near, 0), (9, [1.0, 0.1, 0.0], 0), (10, near, 1), (11, near, None), (12, near, None), (13, [1.0, 0.0], 0),
        (14, [1.0, 0.0], 0), (None, [1.0, 0.2, 0.0], 0), (None, [0.0, 1.0, 0.0], 0), (None, [0.0, 1.0, 0.01], 0), (15, [1e-30, 0.0, 0.0], 0),
        (16, [3e38, 0.0, 0.0], 0), (17, [-1.0, 0.0, 0.0], 0), (18, [-0.0, 0.0, 5.0], 1), (18, [0.0, 0.0, 5.0], 1),
    ]
    got = sorted((tuple(r) for r in vector_forest.near_copies(table(spark, rows)).collect()), key=key)
    want = sorted(((i, n, c, i == c) for i, n, c, _ in expected(rows)), key=key)
    assert got == want
    assert vector_forest.near_copies(table(spark, rows).limit(0)).count() == 0
    doubles = vector_forest.near_copies(table(spark, rows, "double"))
    assert sorted((tuple(r) for r in doubles.collect()), key=key) == want


@pytest.mark.parametrize("cosine", [0.93, 0.8])
def test_clouds_and_copies(spark, cosine):
    rng = np.random.default_rng(7)
    rows = clouds(rng, 32, 60, 0.15, 800)
    rows += [(len(rows) + i, rows[5][1], rows[5][2]) for i in range(300)]  # copies of one vector
    got = sorted(tuple(r) for r in vector_forest.near_copies(table(spark, rows), cosine=cosine, leaf=64, sample=512, trees=12).collect())
    want = sorted(expected(rows, cosine))
    assert [g[0] for g in got] == [w[0] for w in want]
    assert all(g[1] <= w[1] for g, w in zip(got, want))  # none below the threshold, none counted twice
    assert sum(g[1] for g in got) >= 0.97 * sum(w[1] for w in want)
    assert sum(g[2] == w[2] for g, w in zip(got, want)) >= 0.97 * len(want)


def test_recall_at_the_threshold(spark):
    """Pairs just above the threshold among many vectors, several rounds of subtrees, labels of unequal size."""
    rng = np.random.default_rng(11)
    base = rng.normal(size=(3000, 24))
    base /= np.linalg.norm(base, axis=1, keepdims=True)
    aside = rng.normal(size=base.shape)
    aside -= (aside * base).sum(axis=1, keepdims=True) * base
    aside /= np.linalg.norm(aside, axis=1, keepdims=True)
    cosines = rng.uniform(0.91, 0.96, size=(len(base), 1))
    mates = cosines * base + np.sqrt(1 - cosines**2) * aside
    rows = [(i, np.float32(v).tolist(), 1 if i % 3000 < 1000 else 0) for i, v in enumerate(np.concatenate((base, mates)))]
    got = {r.vec_id: r.n_links for r in vector_forest.near_copies(table(spark, rows), leaf=100, sample=400).collect()}
    want = brute(rows)
    assert all(got[i] <= len(want[i]) for i in got)
    found, there = sum(got.values()), sum(len(x) for x in want.values())
    assert there > 2000 and found >= 0.9 * there


def test_dense_leaves_are_compared_in_parts(spark):
    """A cloud closer than any margin, larger than a leaf: every vector is linked with all others."""
    rng = np.random.default_rng(3)
    crowd = np.ones(16) + rng.normal(size=(700, 16)) * 0.001
    rows = [(i, np.float32(v).tolist(), 0) for i, v in enumerate(np.concatenate((crowd, rng.normal(size=(300, 16)))))]
    got = sorted(tuple(r) for r in vector_forest.near_copies(table(spark, rows), leaf=50, sample=300).collect())
    assert [g[1] for g in got[:700]] == [699] * 700 and {g[2] for g in got[:700]} == {0}


def test_query_against_all_pairs(spark, small):
    rows = [(r.vec_id, list(r.embedding), r.label) for r in spark.read.parquet(f"{small}/embeddings.parquet").collect()]
    got = queries.registered()["op13_vector_forest"](spark, small)
    assert got.columns == ["vec_id", "n_links", "component_id", "kept"]
    assert sorted(tuple(r) for r in got.collect()) == sorted(expected(rows))


def test_link_counts_do_not_depend_on_layout(spark):
    rng = np.random.default_rng(9)
    rows = clouds(rng, 16, 20, 0.2, 200)
    one = sorted(tuple(r) for r in vector_forest.near_copies(table(spark, rows), leaf=64).collect())
    two = vector_forest.near_copies(table(spark, rows[::-1]).repartition(7), leaf=64).collect()
    lost = [(a, tuple(b)) for a, b in zip(one, sorted(tuple(r) for r in two)) if a != tuple(b)]
    assert len(lost) <= 0.05 * len(one)
