"""Near pairs that no band and no bound of bits shows: an exact join finds them all."""

import random

import corpus_pipeline
import numpy as np
import pytest

from pulseweave.llm import near_copies, simhash
from pulseweave.llm.near_copies import BITS, SHARE, bands, shingle_set


def jaccard(a, b):
    both = len(np.intersect1d(a, b))
    return both / (len(a) + len(b) - both)


def bandless(seed):
    """Two texts without a common band (one pair in 20,000 of this kind)."""
    rng = random.Random(seed)
    n = rng.choice((12, 16, 25, 40, 60))
    words = [f"w{rng.randrange(9999)}" for _ in range(n)]
    copy = list(words)
    if rng.random() < 0.5:
        copy = copy[:-rng.randrange(1, max(2, n // 6))]
    else:
        copy[rng.randrange(n)] = "x"
    return " ".join(words), " ".join(copy)


def distant():
    """Two texts of similarity 0.8 whose fingerprints are far apart: each word of the second
    one's end is the one of many that takes it furthest."""
    rng = random.Random(5)
    words = [f"w{rng.randrange(9999)}" for _ in range(40)]
    first = simhash.fingerprint_of(shingle_set(" ".join(words).encode()))
    copy = list(words)
    for _ in range(9):
        copy = max(([*copy, f"y{rng.randrange(99999)}"] for _ in range(300)), key=lambda x: (
            simhash.fingerprint_of(shingle_set(" ".join(x).encode())) ^ first).bit_count())
    return " ".join(words), " ".join(copy)


@pytest.mark.parametrize("seed", [15961, 32545])
def test_pair_without_a_common_band(spark, corpus, seed):
    a, b = (shingle_set(t.encode()) for t in bandless(seed))
    assert jaccard(a, b) >= SHARE and not (bands(a) == bands(b)).any()
    docs = corpus([(1, bandless(seed)[0]), (2, bandless(seed)[1]), (3, "another text")])
    kept = [r.doc_id for r in corpus_pipeline.near_dedup(spark, docs, "").collect()]
    assert sorted(kept) == [1, 3]


def test_pair_over_the_bound_of_bits(spark, corpus):
    a, b = (shingle_set(t.encode()) for t in distant())
    assert jaccard(a, b) >= SHARE
    assert (simhash.fingerprint_of(a) ^ simhash.fingerprint_of(b)).bit_count() > BITS
    docs = corpus([(1, distant()[0]), (2, distant()[1]), (3, "another text")])
    kept = [r.doc_id for r in corpus_pipeline.near_dedup(spark, docs, "").collect()]
    assert sorted(kept) == [1, 3]


def crowd():
    """Texts with shared passages, near copies at all distances, short texts, a dense cluster,
    null and empty texts, and a text that comes often."""
    rng = random.Random(11)
    passages = [[f"p{k}w{i}" for i in range(30)] for k in range(3)]
    texts = []
    for i in range(90):
        words = [f"w{rng.randrange(3000)}" for _ in range(rng.choice((3, 6, 9, 14, 30, 80)))]
        if i % 3 == 0:
            words = [*words[:8], *rng.choice(passages), *words[8:]]
        texts.append(words)
        for _ in range(rng.randrange(3)):
            copy = list(words)
            for _ in range(rng.randrange(1, 4)):
                copy[rng.randrange(len(copy))] = f"x{rng.randrange(3000)}"
            texts.append(copy[:len(copy) - rng.randrange(3)])
    base = [f"c{i}" for i in range(60)]
    for i in range(40):
        texts.append([*base, *[f"z{i}v{k}" for k in range(rng.randrange(14))]])
    rows = [(i, " ".join(t)) for i, t in enumerate(texts)]
    return [*rows, (990, None), (991, ""), (None, rows[5][1]),
            *[(992 + i, rows[0][1].upper()) for i in range(6)]]


def plain(rows):
    """Smallest ids of the components of near texts, by all pairs."""
    rows = [(i, shingle_set((t or "").encode())) for i, t in rows if i is not None]
    label = {i: i for i, _ in rows}
    near = [(i, j) for i, a in rows for j, b in rows if i < j and (
        jaccard(a, b) >= SHARE if len(a) and len(b) else len(a) == len(b))]
    while True:
        before = dict(label)
        for i, j in near:
            label[i] = label[j] = min(label[i], label[j])
        if before == label:
            return {i for i, x in label.items() if i == x}


@pytest.mark.parametrize("group, rounds", [(256, 4), (2, 4), (2, 2), (0, 9)])
def test_join_alone_finds_all_near_pairs(spark, corpus, monkeypatch, group, rounds):
    """Without any candidates of the index, and with shingles that are set aside."""
    monkeypatch.setattr(near_copies, "candidates", lambda *_: spark.createDataFrame(
        [], "a long, b long"))
    monkeypatch.setattr(near_copies, "GROUP", group)
    monkeypatch.setattr(near_copies, "ROUNDS", rounds)
    calls, real = [], near_copies.firsts
    monkeypatch.setattr(near_copies, "firsts", lambda *x: calls.append(1) or real(*x))
    rows = crowd()
    kept = [r.doc_id for r in corpus_pipeline.near_dedup(
        spark, corpus(rows).repartition(3), "").collect()]
    wanted = plain(rows)
    assert len(wanted) < len(rows) - 60
    assert len(calls) == 1 if group == 256 else 1 < len(calls) <= rounds
    assert sorted(i for i in kept if i is not None) == sorted(wanted)


def test_parities_bound_the_difference():
    rng = np.random.default_rng(1)
    for n in (1, 5, 64, 65, 700):
        base = rng.integers(0, 1 << 63, n, dtype=np.uint64)
        for m in (0, 1, n // 2, 3 * n):
            other = np.unique(np.concatenate((base[m // 3:], rng.integers(0, 1 << 63, m, dtype=np.uint64))))
            differ = len(np.setxor1d(base, other))
            for a, b in ((np.unique(base), other), (other, np.unique(base))):
                assert near_copies.apart(near_copies.parity(a), near_copies.parity(b)) <= differ


def test_pairs_of_a_shingle_in_blocks(monkeypatch):
    """Every pair in the bounds once, whatever the blocks."""
    rng = np.random.default_rng(4)
    size = rng.integers(5, 40, 70)
    rows = np.stack((np.arange(70), rng.integers(0, 12, 70), size, rng.integers(0, 3, 70)))
    near = {(i, j) for i in range(70) for j in range(i) if rows[1, i] != rows[1, j]
            and min(size[i] - rows[3, i], size[j] - rows[3, j]) * 1.8
            >= 0.8 * (size[i] + size[j]) - 1e-6}
    for block in (1, 7, 1 << 18):
        monkeypatch.setattr(near_copies, "BLOCK", block)
        found = [p for i, j in near_copies.pairs_of(rows, 0.8)
                 for p in zip(np.maximum(i, j).tolist(), np.minimum(i, j).tolist())]
        assert set(found) == near and len(found) == len(near)
