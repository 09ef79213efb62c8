"""Quality rules, sharding and pseudonyms against plain versions."""

import collections
import datetime
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from pulseweave.llm import kd_shards, pseudonyms, quality
from pulseweave.llm.queries import op2_kd_shards


def plain_counts(text, split_words):
    w = split_words(text)
    grams = collections.Counter(tuple(w[i:i + 3]) for i in range(len(w) - 2))
    covered = {i + k for i in range(len(w) - 2) if grams[tuple(w[i:i + 3])] > 1 for k in range(3)}
    lines = [x for x in (text or "").split("\n") if split_words(x)]
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")),
            len(lines) - len(set(lines)), len(covered))


def test_base_counts(corpus, mixed, awkward, split_words):
    rows = [(i, r[1]) for i, r in enumerate([*mixed, *awkward, (0, "a b c a b c # |x| a b c"),
                                             (0, "a b a b a b a"), (0, "x\nx\n \n x\nx")])]
    found = {r.doc_id: r for r in quality.judge(corpus(rows)).collect()}
    for i, text in rows:
        r = found[i]
        n = plain_counts(text, split_words)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == n
        assert r.base_failed == (n[0] < 50 or 100 * n[4] > 50 * n[0])


def test_frequent_lines_go_but_one_stays(corpus):
    letter = "abcdefghijklmnopqrst".__getitem__  # digits are alike to a normalised line
    own = lambda i: " ".join(f"own{letter(i)}x{k}" for k in range(60))
    shared = " ".join(f"shared{k}" for k in range(50))
    rows = [(i, f"{own(i)}\nFooter  Number {i}", "a") for i in range(20)]
    rows += [(100 + i, f"{shared}\n{shared.upper()} {i}", "a") for i in range(20)]
    rows += [(200, shared, "b")]
    docs = corpus(rows)
    limits = quality.LineLimits(min_docs=5, share=0.1)
    kept = {r.doc_id for r in quality.judge(docs, limits).collect() if r.kept}
    assert kept == {*range(20), 100, 200}
    out = {r.doc_id: r for r in quality.keep_good(docs, limits).collect()}
    assert set(out) == kept
    assert out[0].text.endswith("Footer  Number 0") and out[3].text == own(3)
    assert out[3].n_chars == len(out[3].text) and out[100].text == dict(r[:2] for r in rows)[100]


@pytest.mark.parametrize("shards", [1, 5, 24])
def test_shards_balance(spark, corpus, shards):
    rng = random.Random(shards)
    rows = [(i, "x" * rng.randint(0, 400), f"src{rng.choice([0, 0, 0, 1, 2])}") for i in range(1500)]
    rows += [(5000 + i, "the same text in a third of all documents" * 5, "src0") for i in range(700)]
    found = kd_shards.shard(spark, corpus(rows), shards).collect()
    by = collections.defaultdict(list)
    for r in found:
        by[r.shard].append(r)
    assert sorted(by) == list(range(shards))
    total = sum(r.size for r in found)
    assert total == sum(len(t.encode()) + 8 for _, t, _ in rows)
    texts = {i: t for i, t, _ in rows}
    for members in by.values():
        assert abs(sum(r.size for r in members) - total / shards) <= 2 * 410
        assert sorted(r.slot for r in members) == list(range(len(members)))
        assert all(r.text_crc32 == zlib.crc32(texts[r.doc_id].encode()) for r in members)


def test_shards_do_not_depend_on_partitions(spark, corpus, mixed):
    docs = corpus(mixed)
    a, b = (kd_shards.shard(spark, d, 6) for d in (docs.repartition(1), docs.repartition(7)))
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))


def test_shard_query(spark, small):
    found = op2_kd_shards(spark, small)
    assert found.columns == ["doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"]
    assert found.count() == 200 and found.filter("law <> 'bytes'").count() == 0


# --- pseudonyms -----------------------------------------------------------------------

def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (2 if i % 2 else 1)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


VALUES = {
    "card": ["4111111111111111", "4111-1111-1111-1111", "5500 0000 0000 0004", "378282246310005",
             "6304000000000000"],
    "phone": ["+1 (743) 555-3824", "743-555-3824", "743.555.3824", "+1 743 555 3824"],
    "ipv4": ["10.0.0.1", "255.255.255.255", "8.8.8.8"],
    "date": ["2024-02-29", "1999/12/31", "31/12/1999", "01.02.2003"],
    "iban": ["GB82WEST12345698765432", "DE89 3704 0044 0532 0130 00", "FR1420041010050500013M02606"],
    "ssn": ["123-45-6789", "899-99-9999", "001-01-0001"],
    "email": ["Jane.Doe99@example.com", "a@b.org", "verylonglocalpartindeed1234567890@x.co.uk"],
}
NOT_VALID = ["GB83WEST12345698765432", "DE00370400440532013000",
             "4111111111111112", "256.1.1.1", "2023-02-29", "666-12-1234", "123-00-1234",
             "1234567", "00/00/2000", "1.2.3"]


def test_valid_values_change_in_format(corpus):
    rows = [(i, f"see {v}, then") for i, v in enumerate(v for k in VALUES for v in VALUES[k])]
    rows += [(100 + i, f"see {v}, then") for i, v in enumerate(NOT_VALID)]
    docs = corpus(rows)
    coded = pseudonyms.pseudonymise(docs, "key one")
    found = {r.doc_id: r for r in coded.collect()}
    kinds = [k for k in VALUES for _ in VALUES[k]]
    shape = lambda t: re.sub("[a-z]", "a", re.sub("[A-Z]", "A", re.sub(r"\d", "0", t)))
    for i, text in rows:
        r = found[i]
        if i >= 100:
            assert r.text == text and r.pii_kinds == []
            continue
        value = r.text.removeprefix("see ").removesuffix(", then")
        assert r.pii_kinds == [kinds[i]] and r.text != text
        if kinds[i] == "ipv4":
            assert all(0 <= int(x) <= 255 for x in value.split("."))
        else:
            assert shape(r.text) == shape(text)
        if kinds[i] == "card":
            assert luhn(re.sub(r"\D", "", value))
        if kinds[i] == "date":
            form = {4: "%Y-%m-%d" if "-" in value else "%Y/%m/%d"}.get(
                len(re.split(r"\D", value)[0]), "%d/%m/%Y" if "/" in value else "%d.%m.%Y")
            datetime.datetime.strptime(value, form)
    assert {r.doc_id: r.text for r in pseudonyms.reveal(coded, "key one").collect()} == dict(rows)
    other = {r.doc_id: r.text for r in pseudonyms.pseudonymise(docs, "key two").collect()}
    assert sum(other[i] != found[i].text for i in range(len(kinds))) >= len(kinds) - 1


def test_equal_values_stay_linked(corpus):
    docs = corpus([(1, "4111111111111111 a"), (2, "b 4111111111111111; 4111111111111111"), (3, None)])
    found = {r.doc_id: r.text for r in pseudonyms.pseudonymise(docs, "k").collect()}
    card = found[1].split()[0]
    assert found[2] == f"b {card}; {card}" and found[3] is None


def test_permutation_is_one_to_one(spark):
    values = spark.range(7 * 11).select(pseudonyms.permuted(F.col("id"), 7, 11, "k", "t").alias("v"))
    assert sorted(r.v for r in values.collect()) == list(range(77))


def test_values_beside_others_do_not_stay(corpus):
    """Neighbours on both sides, times after dates, months first; all of it reversible."""
    card, spaced = "4111111111111111", "4111 1111 1111 1111"
    texts = [f"{spaced} 123", f"{card} 12/27", f"order 12 {spaced}", f"{card} {spaced}",
             f"7 {spaced} 9", "due 12/25/2024", "on 02/29/2024.", "2024-03-25T10:00",
             "99 2024-03-25 123456", "99 123-45-6789 12345", "12/31/1999 31/12/1999",
             f"378282246310005 0000 {card}", "3782 822463 10005 4321"]
    docs = corpus(list(enumerate(texts)))
    coded = pseudonyms.pseudonymise(docs, "k")
    found = {r.doc_id: r for r in coded.collect()}
    for i, text in enumerate(texts):
        assert found[i].pii_kinds and found[i].text != text, text
        for value in (card, spaced, "12/25/2024", "02/29/2024", "2024-03-25", "123-45-6789",
                      "12/31/1999", "378282246310005", "3782 822463 10005"):
            assert value not in found[i].text or value not in text, (text, found[i].text)
    assert {r.doc_id: r.text for r in pseudonyms.reveal(coded, "k").collect()} == dict(
        enumerate(texts))
    linked = [re.sub(r"\D", "", found[i].text)[:16] for i in (0, 1, 3)]
    assert len(set(linked)) == 1
    late = found[5].text.removeprefix("due ")
    assert datetime.datetime.strptime(late, "%m/%d/%Y").day > 12
