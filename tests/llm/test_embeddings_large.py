import numpy as np
import pytest

from tallyforge.llm import embeddings
from tests.llm.test_embeddings import brute_force, got


def around(rng, centre, cosine, count):
    """Vectors at one cosine to a centre."""
    centre = centre / np.linalg.norm(centre)
    noise = rng.standard_normal((count, len(centre)))
    noise -= np.outer(noise @ centre, centre)
    noise /= np.linalg.norm(noise, axis=1, keepdims=True)
    return (cosine * centre + np.sqrt(1 - cosine**2) * noise).tolist()


def test_large_group_without_a_core(make, monkeypatch):
    """Pairwise cosines near 0.96; nobody is within half the angle of the mean."""
    monkeypatch.setattr(embeddings, "BLOCK_ROWS", 100)
    rng = np.random.default_rng(7)
    rows = list(enumerate(around(rng, rng.standard_normal(128), 0.981, 400)))
    rows += [(1000 + i, v) for i, (_, v) in enumerate(rows[:9])]
    assert got(embeddings.near_vectors(make(rows, "vec_id long, embedding array<double>"), window=8)) == brute_force(rows)


def test_two_chained_tight_groups(make, monkeypatch):
    monkeypatch.setattr(embeddings, "BLOCK_ROWS", 50)
    rng = np.random.default_rng(8)
    centre = rng.standard_normal(64)
    centre /= np.linalg.norm(centre)
    across = rng.standard_normal(64)
    across -= across @ centre * centre
    across /= np.linalg.norm(across)
    turn = lambda angle: np.cos(angle) * centre + np.sin(angle) * across
    vectors = around(rng, turn(0), 0.998, 120) + around(rng, turn(0.5), 0.998, 120) + [turn(0.25).tolist()] * 3
    rows = list(enumerate(vectors))
    assert got(embeddings.near_vectors(make(rows, "vec_id long, embedding array<double>"), window=8)) == brute_force(rows)


@pytest.mark.parametrize("common", [0.0, 0.5, 0.8])
def test_recall_with_a_common_direction(make, common):
    """Pairs just above the threshold, in a table whose vectors have a mean cosine of `common` with each other."""
    rng = np.random.default_rng(9)
    dimensions, pairs = 64, 2_500
    direction = rng.standard_normal(dimensions)
    direction /= np.linalg.norm(direction)
    first = np.array(around(rng, direction, np.sqrt(common), pairs))
    rows = []
    for i, v in enumerate(first):
        step = rng.standard_normal(dimensions)
        step -= step @ v * v
        step /= np.linalg.norm(step)
        rows += [(2 * i, v.tolist()), (2 * i + 1, (0.955 * v + np.sqrt(1 - 0.955**2) * step).tolist())]
    vectors = np.array([v for _, v in rows])
    close = np.triu(vectors @ vectors.T >= 0.95, 1)
    found = {r.vec_id: r.n_links for r in embeddings.near_vectors(make(rows, "vec_id long, embedding array<double>"), window=32).collect()}
    true = close.sum(axis=0) + close.sum(axis=1)
    assert all(found[i] <= true[i] for i in range(len(rows)))
    assert sum(found.values()) >= 0.9 * true.sum()


def test_passes_follow_the_chance_of_a_pass():
    assert embeddings.passes_for(1.0) == embeddings.LEAST_PASSES and embeddings.passes_for(0.0) == embeddings.MOST_PASSES
    assert embeddings.passes_for(0.1) == 38
    assert embeddings.same_side(0.95, 0.0) == pytest.approx(1 - np.arccos(0.95) / np.pi) and embeddings.same_side(0.95, 0.99) == 0.5
