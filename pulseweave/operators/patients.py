"""The table of known patients."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from pulseweave.functions.text import ngrams


def distinct_patients(records: DataFrame) -> DataFrame:
    """Each patient once; on a stream the state keeps every id ever seen."""
    return records.select("patient_id").dropDuplicates(["patient_id"])


def new_patients(records: DataFrame, known: DataFrame) -> DataFrame:
    """Patients of ``records`` that are not known yet.

    The records are reduced to distinct ids before the join, so a busy patient
    is one row by then.
    """
    return distinct_patients(records).join(known.select("patient_id"), "patient_id", "left_anti")


def ngram_table(patient_ids: DataFrame, shortest: int = 3, longest: int = 8) -> DataFrame:
    """(gram, patient) pairs, to look ids up by fragment.

    Lookups begin with a gram of three characters, so ``shortest`` is at most that.
    """
    if shortest > 3:
        raise ValueError("lookups need grams of three characters")
    return patient_ids.select(
        "patient_id", F.explode(ngrams(F.col("patient_id"), shortest, longest)).alias("gram"))
