"""The pipeline's near-copy stage against exact shingle similarity."""

import random

import corpus_pipeline
import numpy as np

from pulseweave.llm import near_copies


def test_near_copies_go_and_others_stay(spark, corpus):
    rng = random.Random(3)
    rows, near = [], set()
    for i in range(60):
        words = [f"w{rng.randrange(5000)}" for _ in range(250)]
        rows.append((10 * i, " ".join(words)))
        for k, edits in enumerate((1, 2, 4, 5, 12)):
            copy = list(words)
            for at in rng.sample(range(250), edits):
                copy[at] = f"x{rng.randrange(10**6)}"
            a, b = (set(zip(*[t[j:] for j in range(5)])) for t in (words, copy))
            rows.append((10 * i + 1 + k, " ".join(copy)))
            if len(a & b) >= 0.8 * len(a | b):
                near.add(10 * i + 1 + k)
    assert len(near) > 200
    kept = {r.doc_id for r in corpus_pipeline.near_dedup(spark, corpus(rows), "").collect()}
    assert kept >= {r[0] for r in rows if r[0] % 10 in (0, 5)}
    assert kept == {r[0] for r in rows} - near


def test_components_by_exact_similarity():
    rng = np.random.default_rng(2)
    base = [rng.integers(0, 1 << 60, 100, dtype=np.uint64) for _ in range(4)]
    sets = [np.unique(np.where(rng.random(100) < 0.07, rng.integers(0, 1 << 60, 100), b))
            .astype(np.uint64) for b in base for _ in range(12)]
    label = list(range(len(sets)))
    for _ in sets:
        for i, a in enumerate(sets):
            for j, b in enumerate(sets):
                both = len(np.intersect1d(a, b))
                if 5 * both >= 4 * (len(a) + len(b) - both):
                    label[i] = label[j] = min(label[i], label[j])
    assert near_copies.similar(sets, 0.8).tolist() == label


def test_null_empty_and_repeated_texts(spark, corpus):
    line = "one two three four five six seven"
    rows = [(1, None), (2, ""), (3, " \n"), (4, line), (4, line), (5, line.upper()),
            (None, line), (6, "one two"), (7, "One  two"), (8, "two one")]
    kept = [r.doc_id for r in corpus_pipeline.near_dedup(spark, corpus(rows), "").collect()]
    assert sorted(kept, key=str) == [1, 4, 6, 8, None]
