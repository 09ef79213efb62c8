"""Removal of repeated byte strings, and the transform below it, against plain counting."""

import hashlib
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from pulseweave.llm import bwt, suffix_dedup


def plain(rows, length):
    """(doc_id, bytes, removed, spans, digest) of every row, by counting all windows."""
    texts = [(text or "").encode() for _, text, *_ in rows]
    seen = Counter(t[i:i + length] for t in texts for i in range(len(t) - length + 1))
    out = []
    for (doc_id, *_), text in zip(rows, texts):
        gone = np.zeros(len(text) + 2, bool)
        for i in range(len(text) - length + 1):
            if seen[text[i:i + length]] > 1:
                gone[i + 1:i + length + 1] = True
        kept = bytes(b for b, g in zip(text, gone[1:]) if not g)
        out.append((doc_id, len(text), len(text) - len(kept),
                    int((gone[1:] & ~gone[:-1]).sum()), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def check(spark, corpus, rows, length, **options):
    found = suffix_dedup.dedup_bytes(spark, corpus(rows), length, **options).drop("kept")
    assert sorted((tuple(r) for r in found.collect()), key=str) == plain(rows, length)


@pytest.mark.parametrize("length", [3, 20])
@pytest.mark.parametrize("letters", ["ab", "abcdefghijklmno", "".join(map(chr, range(33, 120)))])
def test_transform(length, letters):
    rng = random.Random(f"{length}{letters}")
    for texts in (1, 2, 40, 200):
        base = ["".join(rng.choices(letters, k=rng.randint(length, 90))) for _ in range(8)]
        made = []
        for _ in range(texts):
            both = rng.choice(base) + rng.choice(base)
            start = rng.randint(0, len(both) - length)
            made.append(both[start:start + rng.randint(length, 150)].encode())
        seen = Counter(t[i:i + length] for t in made for i in range(len(t) - length + 1))
        found = bwt.repeats([np.frombuffer(t, np.uint8) for t in made], length)
        assert [f.tolist() for f in found] == [
            [seen[t[i:i + length]] > 1 for i in range(len(t) - length + 1)] for t in made]


@pytest.mark.parametrize("hot", [suffix_dedup.HOT, 3])
def test_plain_counting(spark, corpus, mixed, hot):
    """Passages, copies and near copies; with most routes hot too."""
    rows = mixed + [(1000 + i, mixed[i][1]) for i in range(9)]
    check(spark, corpus, rows, 40, anchor=12, hot=hot)


def test_hot_passage(spark, corpus):
    """A passage in a third of the documents, over the bound of hot routes."""
    rng = random.Random(2)
    passage = "".join(rng.choices("abcdefgh ", k=400))
    rows = []
    for i in range(300):
        own = "".join(rng.choices("klmnopqrst ", k=300))
        rows.append((i, own[:150] + passage + own[150:] if i % 3 == 0 else own))
    check(spark, corpus, rows, 200, hot=20)


def test_awkward(spark, corpus, awkward):
    """Nulls, empty, repeated, periodic and long texts, several bytes a character."""
    rows = [r for r in awkward if r[0] != 5] + [
        (20, "a" * 3000), (21, "ab" * 900), (22, "é漢" * 300), (22, "other"), (5, None)]
    check(spark, corpus, rows, 200)
    check(spark, corpus, [], 200)


def test_only_open_pieces_are_inserted(monkeypatch):
    """Of segments with one route only windows that may occur again enter the transform, and
    the marks are those of counting."""
    rng = random.Random(5)
    letters = lambda n: "".join(rng.choices("abcdefghijkl ", k=n)).encode()
    base = letters(330)
    bodies = [base, base[:270] + letters(60), letters(60) + base[60:], base[40:300],
              *(letters(300) for _ in range(20))]
    inserted = []
    monkeypatch.setattr(suffix_dedup, "repeats",
                        lambda texts, n: inserted.extend(texts) or bwt.repeats(texts, n))
    table = pa.table({"route": [7] * len(bodies), "seg": range(len(bodies)),
                      "body": pa.array(bodies, pa.binary()), "n": [1] * len(bodies)})
    marked = {i: np.zeros(len(b) + 1, bool) for i, b in enumerate(bodies)}
    for row in suffix_dedup._marks(table, 200).to_pylist():
        for a, b in np.frombuffer(row["runs"], np.int32).reshape(-1, 2):
            marked[row["seg"]][a:b] = True
    seen = Counter(b[i:i + 200] for b in bodies for i in range(len(b) - 199))
    for i, body in enumerate(bodies):
        gone = np.zeros(len(body) + 1, bool)
        for k in range(len(body) - 199):
            if seen[body[k:k + 200]] > 1:
                gone[k:k + 200] = True
        assert (marked[i] == gone).all()
    assert 0 < sum(map(len, inserted)) <= sum(map(len, bodies[:4])) < sum(map(len, bodies)) // 5


def test_segments_of_periodic_texts():
    """Long runs are cut, and a route that is in a segment twice is counted twice."""
    found = suffix_dedup.Segments(pa.array(["a" * 500, "x" + "ab" * 60, "short"]), 40, 12)
    assert found.n.max() == 29 and found.n.sum() == 500 - 39 + 121 - 39
    assert found.times[:10].tolist() == [2] * 10


def test_shard_of_exact_copies_alone():
    """Nothing is left to cut or insert, and every copy is marked whole."""
    table = pa.table({"route": [7, 8], "seg": [1, 2], "n": [2, 3],
                      "body": pa.array([b"a" * 210, b"b" * 220], pa.binary())})
    rows = suffix_dedup._marks(table, 200).to_pylist()
    assert [(r["seg"], *np.frombuffer(r["runs"], np.int32).tolist()) for r in rows] == [
        (1, 0, 210), (2, 0, 220)]
