"""Small column helpers shared by the operators.

Every operator reads documents as (doc_id, text, source), whatever other columns the
table has; a null text counts as empty and a null source as the host ''.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from pulseweave.session import shared_dir

#: White space of the word rule: space and U+0009 to U+000D.
BLANKS = " \t\n\x0b\f\r"
BLANK_RUN = r"[\x20\x09-\x0D]+"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once per row, however often used."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def words(text: Column) -> Column:
    """The words of a text, an empty array for none."""
    bare = F.btrim(text, F.lit(BLANKS))
    return F.when(F.length(bare) > 0, F.split(bare, BLANK_RUN)).otherwise(
        F.array().cast("array<string>"))


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def written(spark: SparkSession, frame: DataFrame, purpose: str) -> DataFrame:
    """Write to the shared folder and read back: cuts lineage and survives lost executors."""
    path = shared_dir(spark, purpose)
    frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def salted(left: DataFrame, right: DataFrame, keys: list[str], spread: Column,
           salts: int = 8) -> DataFrame:
    """Inner join on ``keys`` with a hot key's left rows spread over ``salts`` tasks.

    ``right`` has few rows a key and is repeated once per salt.  Both sides are dealt
    for the join alone, so that the planner can split what is still too large.
    """
    name = "_salt"
    a = left.withColumn(name, F.pmod(F.xxhash64(spread), F.lit(salts)).cast("int"))
    b = right.withColumn(name, F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return a.join(b, [*keys, name]).drop(name)
