"""Every operator and stage on awkward rows, an empty table and clashing column names."""

import corpus_pipeline
import pytest

from pulseweave.llm import (decontamination, kd_shards, line_dedup, lm_scoring, merkle,
                            pseudonyms, quality, secrets, sentencepiece_backend, simhash,
                            substring_dedup, suffix_dedup)
from pulseweave.llm.queries import model_bytes

OPERATORS = {
    "secrets": secrets.scan_secrets,
    "shards": kd_shards.shard,
    "pseudonyms": lambda spark, docs: pseudonyms.pseudonymise(docs, "k"),
    "substrings": substring_dedup.dedup_substrings,
    "scores": lambda spark, docs: lm_scoring.score(docs),
    "lines": line_dedup.dedup_report,
    "simhash": simhash.near_duplicates,
    "quality": lambda spark, docs: quality.judge(docs),
    "bytes": suffix_dedup.dedup_bytes,
    "merkle": merkle.manifest,
    "encode": lambda spark, docs: sentencepiece_backend.encode(docs, model_bytes()),
}


@pytest.fixture(scope="module")
def items(spark):
    return spark.createDataFrame(
        [(1, "one two three four five six seven eight"), (2, None), (3, ""), (None, "a b")],
        "item_id long, text string")


@pytest.mark.parametrize("name", sorted(OPERATORS))
def test_one_row_per_row(name, spark, corpus, awkward):
    found = OPERATORS[name](spark, corpus(awkward)).collect()
    assert sorted(r.doc_id if r.doc_id is not None else -1 for r in found) == sorted(
        r[0] if r[0] is not None else -1 for r in awkward)


@pytest.mark.parametrize("name", sorted(OPERATORS))
def test_empty_table(name, spark, corpus):
    assert OPERATORS[name](spark, corpus([])).collect() == []


def test_decontamination(spark, corpus, awkward, items):
    found = decontamination.contamination(spark, corpus(awkward), items).collect()
    assert len(found) == len(awkward)
    assert {r.doc_id for r in found if r.contaminated} == {5, 6, 7, 8, 9, 11, None}
    assert decontamination.contamination(spark, corpus([]), items).count() == 0
    none = decontamination.contamination(spark, corpus(awkward), items.limit(0))
    assert none.filter("contaminated").count() == 0


@pytest.mark.parametrize("stage", range(len(corpus_pipeline.STAGES)))
def test_stage(stage, spark, corpus, awkward, small):
    name, function = corpus_pipeline.STAGES[stage]
    docs = corpus(awkward)
    out = function(spark, docs, small)
    if stage < len(corpus_pipeline.STAGES) - 1:
        assert out.columns == docs.columns
        assert [f.dataType for f in out.schema] == [f.dataType for f in docs.schema]
    assert out.count() <= len(awkward)
    assert function(spark, corpus([]), small).count() == 0
