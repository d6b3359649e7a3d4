import math

import numpy as np
import pytest

from tallyforge.llm import embeddings


def brute_force(rows, threshold=0.95):
    """Links and components by comparing all pairs."""
    def unit(v):
        if not v or any(x is None or not math.isfinite(x) for x in v) or not any(v):
            return None
        a = np.array(v, float)
        a = a / np.abs(a).max()
        return a / np.linalg.norm(a)

    units = [unit(v) for _, v in rows]
    links = [0] * len(rows)
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if units[i] is not None and units[j] is not None and len(units[i]) == len(units[j]) and units[i] @ units[j] >= threshold:
                links[i] += 1
                links[j] += 1
                root[find(i)] = find(j)
    out = []
    for i, (key, _) in enumerate(rows):
        keys = [rows[j][0] for j in range(len(rows)) if find(j) == find(i) and rows[j][0] is not None]
        component = min(keys) if keys else None
        out.append((key, links[i], component, key == component))
    return sorted(out, key=repr)


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def clusters(rng, sizes, dim, noise):
    rows = []
    for size in sizes:
        centre = rng.standard_normal(dim)
        rows += [(centre + noise * rng.standard_normal(dim)).astype(np.float32).tolist() for _ in range(size)]
    return rows


def test_whole_table(spark, folder):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{folder}/embeddings.parquet").collect()]
    assert got(embeddings.op8_sorted_projection_near_dedup(spark, folder)) == brute_force(rows)


def test_recall_and_no_false_links(make):
    rng = np.random.default_rng(3)
    vectors = clusters(rng, [2] * 120 + [9] * 10 + [60] * 2 + [1] * 300, 24, 0.12)
    rows = list(enumerate(vectors))
    want = {k: n for k, n, *_ in brute_force(rows)}
    found = {r.vec_id: r.n_links for r in embeddings.near_vectors(make(rows, "vec_id long, embedding array<float>"), window=16).collect()}
    assert all(found[k] <= n for k, n in want.items())
    assert sum(found.values()) >= 0.9 * sum(want.values()) > 0


def test_groups_larger_than_the_window_are_counted_whole(make):
    rng = np.random.default_rng(4)
    rows = list(enumerate(clusters(rng, [150, 1, 2, 40], 16, 0.02)))
    rows += [(1000 + i, v) for i, (_, v) in enumerate(rows[:30])]  # copies
    df = make(rows, "vec_id long, embedding array<float>")
    assert got(embeddings.near_vectors(df, window=8)) == brute_force(rows)


def test_odd_vectors(make):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, None), (2, []), (3, [0.0, 0.0]), (4, [nan, 1.0]), (5, [inf, 1.0]), (6, [None, 1.0]), (7, [1.0, 0.0]), (8, [1.0, 0.0]), (8, [1.0, 0.0]),
        (9, [2.0, 0.0]), (10, [1e200, 1e199]), (11, [1.0, 0.1]), (12, [1.0]), (13, [-1.0, 0.0]), (None, [5.0, 0.1]), (None, [0.0, 3.0]), (14, [1e-200, 0.0]),
    ]
    df = make([(k, v, 1, "x") for k, v in rows], "vec_id long, embedding array<double>, cid int, key string")
    want = [(k, n, c, True if k is None and c is None else kept) for k, n, c, kept in brute_force(rows)]
    assert got(embeddings.near_vectors(df)) == sorted(want, key=repr)
    assert embeddings.near_vectors(df.limit(0)).collect() == []


@pytest.mark.parametrize("chance", [1.0, 0.9, 0.5, 0.2, 0.05])
def test_passes_grow_as_a_pass_finds_less(chance):
    passes = embeddings.passes_for(chance)
    assert embeddings.LEAST_PASSES <= passes <= embeddings.MOST_PASSES and (1 - chance) ** passes <= embeddings.MISSED + 1e-9
