"""The pipeline against a plain version of its stages' own rules, and the stages' contract."""

import random
import re
import shutil

import corpus_pipeline
import pytest
import sentencepiece

from pulseweave.llm.line_dedup import BOUND
from pulseweave.llm.near_copies import SHARE, SHINGLE
from pulseweave.llm.queries import MODEL
from test_models import plain_tiling
from test_native_operators import plain_counts


def variants(units):
    return {units} | {units[:i] + units[i + 1:] for i in range(len(units))}


def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    long, short = (a, b) if len(a) > len(b) else (b, a)
    return len(long) == len(short) + 1 and short in variants(long)


def plain_lines(docs, split_words, low):
    """The lines of each document that an earlier line equals or comes near: one word in lines
    of ``near_words`` or more, else one character in lines of ``near_chars`` or more, where
    one of both lines is short."""
    lines = [(i, k, tuple(split_words(low(line)))) for i, text in sorted(docs.items())
             for k, line in enumerate(text.split("\n"))]
    first = {}
    for i, k, words in lines:
        if words:
            first.setdefault(words, (i, k))
    index = {}
    for words in first:
        joined = " ".join(words)
        long = len(words) >= BOUND.near_words
        keys = [("w", v) for v in variants(words)] if long else []
        if not long and len(joined) >= BOUND.near_chars:
            keys += [("c", v) for v in variants(joined)]
        for key in keys:
            index.setdefault(key, []).append(words)
    least = dict(first)
    for (kind, _), group in index.items():
        for a in group:
            for b in group:
                if a != b and (one_edit(a, b) if kind == "w"
                               else one_edit(" ".join(a), " ".join(b))):
                    least[a] = min(least[a], first[b])
    gone = {}
    for i, k, words in lines:
        if words and (i, k) > least[words]:
            gone.setdefault(i, set()).add(k)
    return gone


def shingles(text, split_words, low):
    words = split_words(low(text))
    if len(words) < SHINGLE:
        return frozenset([tuple(words)])
    return frozenset(zip(*(words[i:] for i in range(SHINGLE))))


def plain_pipeline(rows, items, split_words, low):
    """(doc_id, text) that reach the last stage.  No line of these tables comes near the
    limits of the quality rules, which leaves their base part."""
    docs = {}
    for doc_id, text in rows:
        n = plain_counts(text, split_words)
        if n[0] >= 50 and 100 * n[4] <= 50 * n[0]:
            docs[doc_id] = text
    for doc_id, lines in plain_lines(docs, split_words, low).items():
        rest = "\n".join(x for i, x in enumerate(docs[doc_id].split("\n")) if i not in lines)
        docs[doc_id] = rest
        if not rest.split():
            del docs[doc_id]
    sets = {i: shingles(t, split_words, low) for i, t in docs.items()}
    label = {i: i for i in sets}
    near = [(a, b) for a in sets for b in sets if a < b and len(sets[a] & sets[b])
            >= SHARE * len(sets[a] | sets[b])]
    while True:
        before = dict(label)
        for a, b in near:
            label[a] = label[b] = min(label[a], label[b])
        if before == label:
            break
    docs = {i: t for i, t in docs.items() if label[i] == i}
    tokens = lambda t: re.findall(r"[^\W_]+", t.lower())
    grams = lambda t: {tuple(t[i:i + 5]) for i in range(len(t) - 4)}
    items = [tokens(t) for t in items]
    clean = {}
    for doc_id, text in docs.items():
        words = tokens(text)
        mine = grams(words)
        if not any(2 * plain_tiling(t, words, 5) >= len(t) for t in items if mine & grams(t)):
            clean[doc_id] = text
    return clean


@pytest.fixture(scope="module")
def folder(spark, small, tmp_path_factory):
    """The small table, with copies that four SimHash bits miss (every 60th word replaced, in
    lines so short that the line stage leaves them) and short lines one character apart."""
    out = str(tmp_path_factory.mktemp("pipeline"))
    shutil.copy(f"{small}/benchmark.parquet", f"{out}/benchmark.parquet")
    docs = spark.read.parquet(f"{small}/documents.parquet")
    rng, rows = random.Random(9), []
    for i in range(12):
        words = ["".join(rng.choices("abcdefghij", k=7)) for _ in range(180)]
        rows.append((9000 + 10 * i, "\n".join(words) if i % 2 else " ".join(words)))
        for k in (1, 2):
            copy = list(words)
            for at in range(rng.randrange(30), 180, 60):
                copy[at] = "".join(rng.choices("klmnopqrst", k=7))
            rows.append((9000 + 10 * i + k, " ".join(copy)))
    for i in range(6):
        tail = " ".join("".join(rng.choices("uvwxyz", k=6)) for _ in range(60))
        rows.append((9500 + i, f"contact u{'abcdef'[i]} here\n{tail}"))
    extra = spark.createDataFrame(rows, "doc_id long, text string").selectExpr(
        "doc_id", "text", "'en' AS lang", "'made' AS source",
        "CAST(length(text) AS BIGINT) AS n_chars")
    docs.unionByName(extra).coalesce(1).write.parquet(f"{out}/documents.parquet")
    return out


def test_pipeline(spark, folder, split_words, low):
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/documents.parquet")
            .select("doc_id", "text").collect()]
    items = [r.text for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    clean = plain_pipeline(rows, items, split_words, low)
    model = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    found = corpus_pipeline.run(spark, folder).collect()
    assert 0 < len(clean) < len(rows)
    assert {r.doc_id: r.ids for r in found} == dict(zip(clean, model.encode(list(clean.values()))))
    assert all(r.parity and r.round_trip for r in found)
    made = {i for i, _ in rows if 9000 <= i < 9200}
    assert len(made - set(clean)) >= 20  # the near copies went


def test_stages_are_the_dealt_ones():
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "quality_rules", "line_dedup", "near_dedup", "decontamination", "sentencepiece"]
