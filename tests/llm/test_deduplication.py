"""Substring, line and SimHash deduplication against brute force."""

import hashlib
import random

import numpy as np
import pytest
import xxhash

from pulseweave.llm import line_dedup, simhash, substring_dedup
from pulseweave.llm.components import components


@pytest.mark.parametrize("window", [5, 20])
def test_substrings(spark, corpus, mixed, split_words, window):
    rows = [*mixed, (500, "a b c d e " * 12), (501, "a b c d e " * 4), (502, None), (503, "")]
    # Small shards: many of them, and windows of one passage in different segments.
    found = {r.doc_id: r for r in substring_dedup.dedup_substrings(
        spark, corpus(rows), window=window, anchor=3, shard_bytes=1 << 20).collect()}
    seen = set()
    for doc_id, text in sorted((r[0], r[1]) for r in rows):
        words = split_words(text)
        gone = [False] * len(words)
        for i in range(len(words) - window + 1):
            gram = tuple(words[i:i + window])
            if gram in seen:
                gone[i:i + window] = [True] * window
            seen.add(gram)
        kept = " ".join(w for w, g in zip(words, gone) if not g)
        r = found[doc_id]
        assert (r.n_words, r.n_removed) == (len(words), sum(gone))
        assert r.kept == kept and r.kept_sha256 == hashlib.sha256(kept.encode()).hexdigest()


def test_backward_search_counts():
    rng = np.random.default_rng(3)
    codes = rng.integers(1, 4, 400)
    codes[[57, 101, 399]] = 0
    index = substring_dedup.FMIndex(codes, 3)
    for _ in range(200):
        pattern = rng.integers(1, 4, rng.integers(1, 6))
        low, high = np.array([0]), np.array([len(codes)])
        for c in pattern[::-1]:
            low, high = index.step(np.array([c]), low, high)
        places = [i for i in range(len(codes)) if (codes[i:i + len(pattern)].tolist()
                                                   == pattern.tolist())]
        assert sorted(index.order[low[0]:max(low[0], high[0])].tolist()) == places


def near_lines(rows, split_words, low, bound):
    first, occurrences = {}, []
    for place, text in sorted(rows):
        for k, line in enumerate(text.split("\n")):
            words = tuple(split_words(low(line)))
            if len(words) >= bound.exact_words:
                occurrences.append((place, k, words))
                first.setdefault(words, (place, k))
    distinct = list(first)
    least = dict(first)
    for a in distinct:
        for b in distinct:
            if min(len(a), len(b)) < bound.near_words or a == b:
                continue
            one = (len(a) == len(b) and sum(x != y for x, y in zip(a, b)) == 1) or (
                len(a) == len(b) + 1 and any(a[:i] + a[i + 1:] == b for i in range(len(a)))) or (
                len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b))))
            if one:
                least[a] = min(least[a], first[b])
    gone = {}
    for place, k, words in occurrences:
        if (place, k) > least[words]:
            gone.setdefault(place, set()).add(k)
    return gone


def test_lines(spark, corpus, split_words, low):
    rng = random.Random(11)
    base = [[rng.choice(["in", "it", "of", "x1", "y2"]) for _ in range(n)]
            for n in (2, 3, 4, 5, 6, 7, 7, 8, 9, 10)]
    rows = []
    for i in range(60):
        lines = []
        for _ in range(rng.randint(0, 4)):
            line = list(rng.choice(base))
            for _ in range(rng.choice([0, 1, 1, 2])):
                at = rng.randrange(len(line))
                edit = rng.randrange(3)
                if edit == 0:
                    line[at] = rng.choice(["In", "z9"])
                elif edit == 1:
                    line.insert(at, rng.choice(["in", "z9"]))
                elif len(line) > 1:
                    del line[at]
            lines.append("  ".join(line))
        rows.append((i * 7 % 61, "\n".join(lines)))
    bound = line_dedup.EditBound(exact_words=3, near_words=5)
    gone = near_lines(rows, split_words, low, bound)
    assert gone
    found = {r.doc_id: r for r in line_dedup.dedup_report(spark, corpus(rows), bound).collect()}
    kept = {r.doc_id: r for r in line_dedup.dedup_lines(spark, corpus(rows), bound).collect()}
    for i, text in rows:
        rest = "\n".join(x for k, x in enumerate(text.split("\n")) if k not in gone.get(i, ()))
        assert found[i].n_removed == len(gone.get(i, ()))
        assert found[i].kept_sha256 == hashlib.sha256(rest.encode()).hexdigest()
        assert found[i].gone == (i in gone and not rest.split())
        assert found[i].gone or (kept[i].text, kept[i].n_chars) == (rest, len(rest))
    assert set(kept) == {i for i, _ in rows if not found[i].gone}


def plain_fingerprint(text, split_words, low):
    words = split_words(low(text or ""))
    if not words:
        return 0
    n = min(4, len(words))
    hashes = [xxhash.xxh64_intdigest(" ".join(words[i:i + n]).encode(), 42)
              for i in range(len(words) - n + 1)]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_simhash(spark, corpus, mixed, split_words, low):
    rows = [*mixed, (300, None), (301, "one two"), (302, "")]
    found = {r.doc_id: r for r in simhash.near_duplicates(spark, corpus(rows)).collect()}
    prints = {r[0]: plain_fingerprint(r[1], split_words, low) for r in rows}
    label = {i: i for i in prints}
    for _ in range(len(label)):
        before = dict(label)
        for a in prints:
            label[a] = min(label[b] for b in prints if (prints[a] ^ prints[b]).bit_count() <= 4)
        if before == label:
            break
    assert {i: r.fingerprint for i, r in found.items()} == {
        i: f"{p:016x}" for i, p in prints.items()}
    assert {i: r.component_id for i, r in found.items()} == label
    kept = simhash.keep_one(spark, corpus([*rows, rows[0]]))
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(label.values()))


def brute_links(fps, bits):
    root = {x: x for x in fps}
    for a in fps:
        for b in fps:
            if (a ^ b).bit_count() <= bits:
                x, y = root[a], root[b]
                if x != y:
                    root = {k: min(x, y) if v in (x, y) else v for k, v in root.items()}
    return {frozenset(k for k in root if root[k] == v) for v in root.values()}


@pytest.mark.parametrize("split_above", [3, 20_000])
def test_links_of_dense_clusters(spark, split_above):
    rng = random.Random(5)
    fps = set()
    for _ in range(6):
        centre = rng.getrandbits(64)
        for _ in range(60):
            x = centre
            for _ in range(rng.randint(0, 7)):
                x ^= 1 << rng.randrange(64)
            fps.add(x)
    signed = [(x - (1 << 64) if x >> 63 else x,) for x in fps]
    edges = simhash.links(spark.createDataFrame(signed, "fp long"), 4, split_above)
    found = components(spark, edges).collect()
    groups = {}
    for r in found:
        groups.setdefault(r.label, set()).add(r.node % (1 << 64))
    mine = {frozenset(g) for g in groups.values()}
    assert mine == {g for g in brute_links(sorted(fps), 4) if len(g) > 1}


def test_tree_search_equals_all_pairs():
    rng = np.random.default_rng(1)
    centre = rng.integers(0, 2**63, 30, dtype=np.uint64)
    fps = np.unique(centre[rng.integers(0, 30, 3000)]
                    ^ (np.uint64(1) << rng.integers(0, 64, 3000).astype(np.uint64))
                    ^ (np.uint64(1) << rng.integers(0, 64, 3000).astype(np.uint64)))
    fps = fps[np.argsort(simhash.gray_rank(fps))]
    pairs = {(min(a, b), max(a, b)) for x, y in simhash.close_pairs(fps, 3)
             for a, b in zip(x.tolist(), y.tolist())}
    near = np.bitwise_count(fps[:, None] ^ fps[None, :]) <= 3
    assert pairs == {(a, b) for a, b in zip(*map(np.ndarray.tolist, np.nonzero(near))) if a < b}


def test_components_of_a_chain(spark):
    edges = spark.range(0, 70).selectExpr("id AS a", "id + 1 AS b").union(
        spark.range(100, 103).selectExpr("id AS a", "102 AS b"))
    found = {r.node: r.label for r in components(spark, edges).collect()}
    assert found == {**{i: 0 for i in range(71)}, **{i: 100 for i in (100, 101, 102)}}
