"""Scores, secrets, decontamination and encoding against plain versions."""

import collections
import hashlib
import math
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
import sentencepiece

from pulseweave.llm import decontamination, lm_scoring, secrets, sentencepiece_backend as sp
from pulseweave.llm.queries import MODEL, model_bytes


@pytest.mark.parametrize("order", [1, 2, 3])
def test_scores(spark, corpus, mixed, split_words, low, order):
    rows = [(r[0], r[1]) for r in mixed] + [(777, None)]
    found = {r.doc_id: r for r in lm_scoring.score(corpus(rows), order, 5.0).collect()}
    tokens = {i: split_words(low(t or "")) + ["</s>"] for i, t in rows}
    held = {i: zlib.crc32(str(i).encode()) % 7 == 2 for i in tokens}
    counts = collections.Counter()
    for i, w in tokens.items():
        for n in range(1, order + 1):
            s = ["<s>"] + w
            counts.update(tuple(s[k:k + n]) for k in range(len(s) - n + 1) if not held[i])
    total = sum(c for g, c in counts.items() if len(g) == 1 and g != ("<s>",))
    types = sum(len(g) == 1 and g != ("<s>",) for g in counts)

    def chance(history, word):
        p = (counts[word,] + 1) / (total + types + 1)
        for n in range(1, len(history) + 1):
            h = tuple(history[-n:])
            if counts[h]:
                p = (counts[h + (word,)] + 5.0 * p) / (counts[h] + 5.0)
        return p

    assert any(held.values())
    for i, w in tokens.items():
        s = ["<s>"] + w
        r = found[i]
        assert (r.held_out, r.n_tokens, r.train_tokens) == (held[i], len(w), total)
        assert r.n_known == sum(counts[x,] > 0 for x in w)
        assert r.base_score == pytest.approx(sum(
            math.log10((counts[x,] + 1) / (total + types + 1)) for x in w))
        assert r.score == pytest.approx(sum(math.log10(chance(
            s[max(0, k - order + 1):k], s[k])) for k in range(1, len(s))))


def test_probabilities_sum_to_one():
    keys = {}
    texts = ["a b a c", "a b b", "c"]
    marked = [["<s>", *t.split(), "</s>"] for t in texts]
    words = sorted({w for m in marked for w in m[1:]})
    counts = collections.Counter(g for m in marked for n in (1, 2)
                                 for g in (tuple(m[k:k + n]) for k in range(len(m) - n + 1)))
    name = lambda g: keys.setdefault(g, len(keys) + 1)
    grams = sorted((name(g), c) for g, c in counts.items())
    total = sum(counts[w,] for w in words)
    model = lm_scoring.Automaton(np.array([k for k, _ in grams], np.uint64),
                                 np.array([c for _, c in grams]), total, len(words), 3.0)
    for context in ("<s>", "a", "b", "c"):
        ps = []
        for w in [*words, "unknown"]:
            one = np.array([name((context,)), name((w,))], np.uint64)
            two = np.array([0, name((context, w))], np.uint64)
            ps.append(10 ** model.traverse([one, two])[1][1])
        assert sum(ps) == pytest.approx(1.0)


def test_held_out_texts_score_better_than_the_base(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    r = lm_scoring.score(docs).filter("held_out").selectExpr("sum(base_score) b", "sum(score) s")
    base, model = r.first()
    assert model > base


# --- secrets --------------------------------------------------------------------------

def plain_spans(text):
    found = [(m.start(), m.end(), 0) for m in re.finditer(
        r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        text) if len(m[2]) >= 8]
    found += [(m.start(), m.end(), 1) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    found += [(m.start(), m.end(), 2) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 32]
    return ",".join(f"{('assign', 'access', 'hex')[k]}:{a}:{b}" for a, b, k in sorted(
        found, key=lambda x: (x[0], x[2])))


def test_secrets(spark, corpus):
    rng = random.Random(2)
    token = lambda n: "".join(rng.choices("0123456789abcdef", k=n))
    rows = [(i, f"é {rng.choice(['Token', 'api_key', 'PASSWORD'])} = \"{token(40)}\" and words "
                f"ordinarylongwordwithoutdigits chapter2019section4 more") for i in range(60)]
    rows += [(100, f"key id AKIA{'ABCD1234' * 2} AKIASHORT"), (101, f"x {token(40)}g{token(31)}"),
             (102, "token=token=short token: abc"), (103, "secretsecret:12345678 passwd=1234567"),
             (104, f"id {token(28)} end"), (105, None)]
    found = {r.doc_id: r for r in secrets.scan_secrets(spark, corpus(rows)).collect()}
    for i, text in rows:
        r, base = found[i], plain_spans(text or "")
        assert r.base_sha256 == hashlib.sha256(base.encode()).hexdigest()
        spans = [s for s in r.spans.split(",") if s]
        assert ",".join(s for s in spans if not s.startswith("grammar")) == base
        assert len(spans) - r.n_grammar == r.n_assign + r.n_access + r.n_hex
    # A shorter credential in the learnt format is added; ordinary runs are not.
    assert found[104].spans == "grammar:3:31"
    assert all(found[i].n_grammar == 0 for i in range(60))


def test_inference_merges_compatible_states():
    rng = random.Random(0)
    values = ["".join(rng.choices("0123456789abcdef", k=rng.randint(20, 40))) for _ in range(400)]
    hexes = secrets.Automaton(values, 0.05)
    assert len(hexes.arcs) < 40
    words = secrets.Automaton(["".join(rng.choices("ghijklmnop", k=20)) for _ in range(400)], 0.05)
    unseen = "".join(rng.choices("0123456789abcdef", k=30))
    assert secrets.score(unseen, [hexes], words) > 10 > secrets.score("g" * 30, [hexes], words)


# --- decontamination ------------------------------------------------------------------

def plain_tiling(a, b, m):
    free_a, free_b = [True] * len(a), [True] * len(b)
    while True:
        best = []
        for i in range(len(a)):
            for j in range(len(b)):
                n = 0
                while (i + n < len(a) and j + n < len(b) and a[i + n] == b[j + n]
                       and free_a[i + n] and free_b[j + n]):
                    n += 1
                if n >= m and (not best or n > best[0][0]):
                    best = [(n, i, j)]
                elif best and n == best[0][0]:
                    best.append((n, i, j))
        if not best:
            return sum(not f for f in free_a)
        for n, i, j in best:
            if all(free_a[i:i + n]) and all(free_b[j:j + n]):
                free_a[i:i + n] = free_b[j:j + n] = [False] * n


def test_tiling(spark, corpus):
    rng = random.Random(4)
    vocabulary = [f"w{i}" for i in range(40)]
    items = [" ".join(rng.choices(vocabulary, k=rng.randint(3, 30))) for _ in range(15)]
    rows = []
    for i in range(60):
        words = rng.choice(items).split()
        cut = sorted(rng.sample(range(len(words)), k=min(2, len(words))))
        parts = [words[:cut[0]], words[cut[0]:cut[-1]], words[cut[-1]:],
                 rng.choices(vocabulary, k=rng.randint(0, 40))]
        rng.shuffle(parts)
        rows.append((i, ", ".join(w.upper() for p in parts[rng.randint(0, 2):] for w in p)))
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    rule = decontamination.Tiling(min_match=3)
    many = decontamination.Tiling(min_match=3, block_tokens=40)
    one = sorted(map(str, decontamination.contamination(spark, corpus(rows), bench, rule).collect()))
    assert one == sorted(map(str, decontamination.contamination(
        spark, corpus(rows), bench, many).collect()))
    found = {r.doc_id: r for r in decontamination.contamination(
        spark, corpus(rows), bench, rule).collect()}
    hit = 0
    for i, text in rows:
        words = re.findall("[a-z0-9]+", text.lower())
        cover = {k: plain_tiling(t.split(), words, 3) / len(t.split()) for k, t in enumerate(items)}
        assert found[i].coverage == pytest.approx(max(cover.values()))
        assert found[i].item_ids == [k for k in sorted(cover) if cover[k] >= 0.5]
        hit += found[i].contaminated
    assert 0 < hit < len(rows)
    kept = {r.doc_id for r in decontamination.clean(spark, corpus(rows), bench, many).collect()}
    assert kept == {i for i, _ in rows if not found[i].contaminated}


# --- encoding -------------------------------------------------------------------------

TEXTS = ["", " ", "  ", "a", " a", "a ", "a  ", "  a  b   c ", "\n\n a\tb", "日本語 🦙 \x00 z",
         "<s> hi </s> <0x0A> <unk>", "é́ ", "ordinary words, with punctuation."]


def test_encoder_equals_sentencepiece():
    theirs = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    encoder = sp.Encoder(model_bytes(), True)
    for texts in (TEXTS, list(reversed(TEXTS)), ["x" * 5000, "the " * 5000]):
        ids, size, agree = encoder.encode(pa.array(texts))
        ends = np.cumsum(size)
        mine = [ids[e - n:e].tolist() for e, n in zip(ends, size)]
        assert mine == theirs.encode(texts) and agree.all()
        assert [sp.decode(x, encoder.bytes, encoder.model) for x in mine] == texts
        assert [encoder.backend.decode(x) for x in mine] == theirs.decode(mine)
        assert encoder.plain(texts)[0] == mine


def test_table_is_emptied(monkeypatch):
    monkeypatch.setattr(sp, "TABLE", 3)
    encoder = sp.Encoder(model_bytes(), False)
    theirs = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    for texts in (["a b c"], ["c d e"], ["a b c d e f g"], ["a"]):
        ids, size, _ = encoder.encode(pa.array(texts))
        assert ids.tolist() == theirs.encode(texts[0])


def varint(n):
    out = b""
    while n > 127:
        out, n = out + bytes([n & 127 | 128]), n >> 7
    return out + bytes([n])


def message(*fields):
    out = b""
    for number, value in fields:
        if isinstance(value, int):
            out += varint(number << 3) + varint(value)
        elif isinstance(value, float):
            out += varint(number << 3 | 5) + np.float32(value).tobytes()
        else:
            out += varint(number << 3 | 2) + varint(len(value)) + value
    return out


def test_unigram_model_with_byte_fallback():
    pieces = [("<unk>", 0.0, 2), ("<s>", 0.0, 3), ("</s>", 0.0, 3)]
    pieces += [(f"<0x{b:02X}>", -20.0, 6) for b in range(256)]
    pieces += [("▁", -4.0, 1), ("a", -3.0, 1), ("b", -3.5, 1), ("▁ab", -2.0, 1), ("ab", -2.5, 1)]
    data = message(*[(1, message((1, p.encode()), (2, s), (3, k))) for p, s, k in pieces],
                   (2, message((3, 1), (35, 1))),
                   (3, message((1, b"identity"), (3, 1), (4, 0), (5, 1))))
    model = sp.parse(data)
    assert (model.kind, model.byte_fallback, len(model.pieces)) == (sp.UNIGRAM, True, len(pieces))
    theirs = sentencepiece.SentencePieceProcessor(model_proto=data)
    encoder = sp.Encoder(data, True)
    texts = ["ab", "a b ab", "ab abab  b", "é", "b é a"]
    ids, size, agree = encoder.encode(pa.array(texts))
    ends = np.cumsum(size)
    assert [ids[e - n:e].tolist() for e, n in zip(ends, size)] == theirs.encode(texts)
    assert agree.all()
