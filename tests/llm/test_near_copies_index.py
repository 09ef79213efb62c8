"""The pipeline's candidates come from the Gray-order hierarchical index."""

import random

import numpy as np
import pytest

from pulseweave.llm import near_copies, simhash


def components(n, pairs):
    label = list(range(n))
    for _ in range(n):
        for a, b in pairs:
            label[a] = label[b] = min(label[a], label[b])
    return label


@pytest.mark.parametrize("n", [2, 31, 90])
def test_forest_has_the_components_of_all_links(n):
    rng = random.Random(n)
    seeds = [rng.getrandbits(64) for _ in range(4)]
    fps = np.array([rng.choice(seeds) ^ sum(1 << rng.randrange(64) for _ in range(9)) % (1 << 64)
                    for _ in range(n)], np.uint64)
    near = [(i, j) for i in range(n) for j in range(i) if np.bitwise_count(fps[i] ^ fps[j]) <= 12]
    a, b = simhash.group_forest(fps, 12)
    assert components(n, list(zip(a.tolist(), b.tolist()))) == components(n, near)
    assert len(a) == n - len(set(components(n, near)))


def test_candidates_of_a_band_go_through_the_index(spark, monkeypatch):
    """60 classes of one band, some with equal fingerprints: the index finds their components."""
    rng = random.Random(7)
    fps = [rng.choice((0, (1 << 62) - 1)) ^ sum({1 << rng.randrange(62) for _ in range(rng.randrange(6))})
           for _ in range(60)]
    classes = spark.createDataFrame([(i, fps[i], [5]) for i in range(60)],
                                    "set_id long, fp long, bands array<long>")

    def refused(*_):
        raise AssertionError("candidates are compared one by one")

    monkeypatch.setattr(near_copies, "walk", refused)
    found = [tuple(r) for r in near_copies.candidates(classes.coalesce(1)).collect()]
    near = [(i, j) for i in range(60) for j in range(i) if (fps[i] ^ fps[j]).bit_count() <= 20]
    assert components(60, found) == components(60, near)
