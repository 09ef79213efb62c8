"""The registered query scores with trigrams."""

import numpy as np
import pyarrow as pa
import pytest

from pulseweave.llm import exchange, lm_scoring
from pulseweave.llm.queries import documents, op5_lm_scoring


def test_query_runs_at_order_three(spark, small):
    found = {r.doc_id: r.score for r in op5_lm_scoring(spark, small).collect()}
    three, two = ({r.doc_id: r.score for r in lm_scoring.score(documents(spark, small), n).collect()}
                  for n in (3, 2))
    assert found == pytest.approx(three) and found != pytest.approx(two)


def test_only_open_ngrams_travel(spark, corpus):
    """A trigram travels only if another group has both of its pairs."""
    words = [f"w{i}" for i in range(4000)]
    rows = [(i, " ".join(words[40 * i:40 * i + 40]) + " shared passage of five words")
            for i in range(100)]
    tables = {}
    for g in range(4):
        docs = corpus(rows[g::4]).selectExpr(f"{g} grp", "doc_id", "pmod(crc32(string(doc_id)), 7) = 2 held",
                                             "text")
        tables[g] = exchange.packed_groups(docs).toArrow()
    whole = [lm_scoring.Group(t, 3) for t in tables.values()]
    short = [row for g, x in enumerate(whole) for n in (1, 2) for row in x.asks(g, n, [], 2)]
    asks = spark.createDataFrame([(b, g, bytearray(c)) for b, g, c in short], exchange.CELLS)
    answer = exchange.met(asks).toArrow()
    for g, x in enumerate(whole):
        mine = answer.filter(pa.compute.equal(answer.column("grp"), g))
        _, shared = x.totals(mine, 2, 2)
        # of five shared words and the end mark: four trigrams; and a last own word before them
        assert len(x.open_keys(3, shared)) == 4 < len(x.orders[2].keys) // 100


def test_equal_high_bits_are_told_apart():
    keys = np.array([5 << 20 | 3, 5 << 20 | 1, 5 << 20 | 3, 1, 5 << 20 | 1], np.uint64)
    distinct, order, first, number = exchange.ranked(keys)
    assert distinct.tolist() == [1, 5 << 20 | 1, 5 << 20 | 3]
    assert (keys[order] == np.sort(keys)).all() and first.tolist() == [0, 1, 3]
    assert (distinct[number] == keys).all()
