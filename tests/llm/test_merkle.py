"""The Merkle manifest against a plain tree, over several block rounds and awkward rows."""

import hashlib
import zlib

import pytest

from pulseweave.llm import merkle

LOWER = str.maketrans(merkle.UPPER, merkle.LOWER)


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(row, text):
    return digest("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in
                          (row.doc_id, row.source, row.lang, row.n_chars, text)))


def tree(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        below = levels[-1]
        levels.append([digest("".join(below[i:i + 8])) for i in range(0, len(below), 8)])
    return levels


def path(levels, i):
    out = []
    for nodes in levels[:-1]:
        start = i // 8 * 8
        out.append(("".join(nodes[start:i]), "".join(nodes[i + 1:start + 8])))
        i //= 8
    return out


def plain(rows):
    langs = {}
    for row in rows:
        langs.setdefault(row.lang, []).append((leaf(row, row.text), row))
    names = sorted(langs, key=lambda x: (x is not None, (x or "").encode()))
    for name in names:
        langs[name].sort(key=lambda x: (x[1].doc_id is not None, x[1].doc_id or 0, x[0]))
    trees = {name: tree([x[0] for x in langs[name]]) for name in names}
    top = tree([trees[name][-1][0] for name in names])
    out = []
    for at, name in enumerate(names):
        for i, (own, row) in enumerate(langs[name]):
            steps = path(trees[name], i) + path(top, at)
            now = own
            if row.doc_id is not None and zlib.crc32(str(row.doc_id).encode()) % 3 == 0:
                now = leaf(row, row.text and row.text.translate(LOWER))
            for left, right in steps:
                now = digest(left + now + right)
            out.append((row.doc_id, own, trees[name][-1][0], top[-1][0],
                        digest("".join(a + b for a, b in steps)), now, now == top[-1][0]))
    return sorted(out, key=str)


SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, grp string"


def check(spark, rows):
    docs = spark.createDataFrame(rows, SCHEMA)
    found = sorted((tuple(r) for r in merkle.manifest(spark, docs).collect()), key=str)
    assert found == plain(docs.collect())


@pytest.mark.parametrize("levels", [1, 3])
def test_plain_tree(spark, monkeypatch, levels):
    """One language with most rows, one with one row, repeated rows, nulls everywhere."""
    monkeypatch.setattr(merkle, "LEVELS", levels)
    monkeypatch.setattr(merkle, "BLOCK", 8 ** levels)
    rows = [(i, f"Text {i} Ä", "en", "s", i, "x") for i in range(700)]
    rows += [(3, "Text 3 Ä", "en", "s", 3, "x")] * 20
    rows += [(3, f"other {i}", "en", None, None, "y") for i in range(9)]
    rows += [(i, None if i % 2 else "", None, "s", i, "x") for i in range(17)]
    rows += [(None, "Null id", "de", "s", 1, "x"), (5, "One", "", "s", 1, "x"),
             (6, "A" * 100_000, "zh", "s", 1, None), (None, None, None, None, None, None)]
    check(spark, rows)


@pytest.mark.parametrize("n", [1, 9, 513])
def test_sizes(spark, n):
    check(spark, [(i, f"T{i}", "en", "s", 1, "x") for i in range(n)])


def test_many_languages(spark, monkeypatch):
    """The tree over languages has several rounds too."""
    monkeypatch.setattr(merkle, "LEVELS", 1)
    monkeypatch.setattr(merkle, "BLOCK", 8)
    check(spark, [(i, f"T{i}", f"l{i % 70}", "s", 1, "x") for i in range(300)])


def test_empty(spark):
    assert merkle.manifest(spark, spark.createDataFrame([], SCHEMA)).collect() == []
