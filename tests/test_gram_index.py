"""Fragment search over the stored gram index."""

import glob
import random

import pyarrow.parquet as pq
import pytest

from pulseweave.functions.ids import uuid_from_long
from pulseweave.operators import gram_index, patients, reads
from pyspark.sql import functions as F


@pytest.fixture(scope="module")
def people(spark):
    """3,000 ids, of which all share a fragment, and some odd ones."""
    rng = random.Random(4)
    ids = ["".join(rng.choices("0123456789abcdef", k=12)) + "-0000-" + str(i) for i in range(3000)]
    return spark.createDataFrame([(x,) for x in ids + ["xxabcxx", "ab", "", None, "a%b_c", ids[0]]],
                                 "patient_id string")


@pytest.fixture(scope="module")
def index(spark, people, tmp_path_factory):
    path = gram_index.build_gram_index(people, str(tmp_path_factory.mktemp("index")), 100, 3)
    return path, gram_index.read_gram_index(spark, path)


@pytest.mark.parametrize("fragment", [
    "ab", "abc", "ABC", "Abc", "0000", "-0000-1", "%b_", "zzz", "-0000-2999", "abcabc", "000000"])
def test_lookup_equals_a_scan(people, index, fragment):
    wanted = reads.matching_patients(people.filter("patient_id IS NOT NULL"), fragment).distinct()
    found = [r.patient_id for r in gram_index.lookup(index[1], fragment).collect()]
    assert sorted(found) == sorted(r.patient_id for r in wanted.collect())


def test_lists_are_bounded_and_files_few(index):
    path, table = index
    assert table.select(F.max(F.size("ids"))).first()[0] < 200  # of 3,000 ids with one gram
    assert len(glob.glob(f"{path}/*.parquet")) == 3


def test_lookup_reads_few_row_groups(spark, tmp_path, monkeypatch):
    """Row groups outside the range of the grams are pruned by their statistics."""
    monkeypatch.setattr(gram_index, "ROW_GROUP_BYTES", 1 << 14)
    ids = spark.range(4000).select(F.sha2(F.col("id").cast("string"), 256).alias("patient_id"))
    path = gram_index.build_gram_index(ids, str(tmp_path), 500, 2)
    groups = [pq.ParquetFile(f).metadata.row_group(i) for f in glob.glob(f"{path}/*.parquet")
              for i in range(pq.ParquetFile(f).metadata.num_row_groups)]
    near = [g for g in groups if g.column(0).statistics.min <= "7f0" <= g.column(0).statistics.max]
    assert len(groups) > 10 and 1 <= len(near) <= 2
    plan = gram_index.lookup(gram_index.read_gram_index(spark, path), "7f0")
    assert "PushedFilters: [IsNotNull(gram), EqualTo(gram,7f0)" in \
        plan._jdf.queryExecution().executedPlan().toString()


def test_empty_table(spark, tmp_path):
    none = spark.createDataFrame([], "patient_id string")
    path = gram_index.build_gram_index(none, str(tmp_path))
    assert gram_index.lookup(gram_index.read_gram_index(spark, path), "abc").count() == 0
    with pytest.raises(ValueError):
        patients.ngram_table(none, shortest=4)


def test_real_ids(spark, tmp_path):
    ids = spark.range(300).select(uuid_from_long(F.col("id")).alias("patient_id"))
    path = gram_index.build_gram_index(ids, str(tmp_path))
    found = gram_index.lookup(gram_index.read_gram_index(spark, path), "00000001").count()
    assert found == ids.filter(F.col("patient_id").contains("00000001")).count()
