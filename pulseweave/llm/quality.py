"""Quality rules: cross-document line frequency after per-document base rules.

Base rules (``n_words`` below 50, or over half of the words in repeated 3-word windows)
reject a document alone.  For the rest of the verdict, normalised lines are hashed and
their distinct documents counted per host (``source``).  A line is above the limit of its
host when more than ``max(min_docs, share * documents of the host)`` distinct texts hold
it; it is removed from every document of the host but the first that holds it (smallest
doc_id), so that one copy stays.  A document that loses more than ``max_lost_percent`` of
the code points in its lines is depleted and rejected.

Texts are counted once however many copies they have; copies are the work of the
deduplication operators.  Null text: no words, rejected by the base rules.  Null source:
the host ''.  A null doc_id is never the first holder.  Repeated rows get equal results.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from pulseweave.llm.columns import BLANK_RUN, let, text_or_empty, words

KEY = ["doc_id", "host", "text_hash"]


@dataclass(frozen=True)
class LineLimits:
    min_docs: int = 50
    share: float = 0.01
    max_lost_percent: int = 50


def repeated_words(of: Column) -> Column:
    """Words covered by 3-word windows that occur twice or more in the array ``of``.

    Window hashes are sorted with their position in the low bits; neighbours that agree
    above those bits are candidates, and only candidates are compared word by word.
    """
    def count(w: Column) -> Column:
        n = F.size(w)
        return F.when(n < 4, F.lit(0).cast("long")).otherwise(
            let(F.call_function("shiftleft", F.lit(1).cast("long"),
                                F.length(F.bin(n.cast("long")))) - 1,
                lambda low: let(_candidates(w, low), lambda at: _covered(w, at))))

    return let(of, count)


def _candidates(w: Column, low: Column) -> Column:
    starts = F.slice(w, F.lit(1), F.size(w) - 2)
    high = F.bitwise_not(low)
    packed = F.sort_array(F.transform(starts, lambda x, i: F.xxhash64(
        x, F.get(w, i + 1), F.get(w, i + 2)).bitwiseAND(high).bitwiseOR(i.cast("long"))))

    def pick(p: Column) -> Column:
        def twin(x: Column, k: Column) -> Column:
            near = lambda y: F.coalesce(
                x.bitwiseXOR(y).bitwiseAND(high) == 0, F.lit(False))
            return near(F.get(p, k - 1)) | near(F.get(p, k + 1))
        return F.transform(F.filter(p, twin), lambda x: x.bitwiseAND(low).cast("int"))

    return let(packed, pick)


def _covered(w: Column, at: Column) -> Column:
    keyed = F.sort_array(F.transform(at, lambda i: F.struct(
        F.concat_ws(" ", F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)).alias("w"),
        i.alias("i"))))

    def places(s: Column) -> Column:
        same = lambda x, k: F.coalesce(x["w"] == F.get(s, k)["w"], F.lit(False))
        twins = F.filter(s, lambda x, k: same(x, k - 1) | same(x, k + 1))
        return F.sort_array(F.transform(twins, lambda x: x["i"]))

    return let(let(keyed, places), lambda p: F.aggregate(
        F.transform(p, lambda i, k: F.least(
            F.lit(3), F.coalesce(F.get(p, k + 1) - i, F.lit(3))).cast("long")),
        F.lit(0).cast("long"), lambda a, b: a + b))


def base_columns(text: Column) -> list[Column]:
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    found = let(words(text), lambda w: F.struct(
        F.size(w).cast("long").alias("n_words"), repeated_words(w).alias("n_repeat_words")))
    dup = let(lines, lambda x: (F.size(x) - F.size(F.array_distinct(x))).cast("long"))
    return [
        found.alias("found"),
        F.length(F.regexp_replace(text, BLANK_RUN, "")).cast("long").alias("word_chars"),
        F.length(F.regexp_replace(text, r"[^#*$%&|<>]+", "")).cast("long").alias("n_symbols"),
        dup.alias("n_dup_lines"),
    ]


def normal_line(line: Column) -> Column:
    """Lower case, runs of white space as one space, runs of digits as one zero."""
    return F.btrim(F.regexp_replace(F.regexp_replace(
        F.lower(line), BLANK_RUN, " "), "[0-9]+", "0"))


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", F.coalesce("source", F.lit("")).alias("host"),
                       text_or_empty().alias("text"),
                       F.xxhash64(text_or_empty()).alias("text_hash"))


def line_rows(docs: DataFrame) -> DataFrame:
    """One row per line with a word: its document's key, hash and length."""
    keyed = _keyed(docs)
    line = F.explode(F.split("text", "\n")).alias("line")
    return (keyed.select(*KEY, line)
            .select(*KEY, normal_line(F.col("line")).alias("line"))
            .filter("line <> ''")
            .select(*KEY, F.xxhash64("line").alias("line_hash"),
                    F.length("line").cast("long").alias("chars")))


def frequent_lines(docs: DataFrame, limits: LineLimits) -> DataFrame:
    """(host, line_hash, first_doc) of the lines above the limit of their host."""
    counts = (line_rows(docs).groupBy("host", "line_hash")
              .agg(F.count_distinct("text_hash").alias("n_docs"),
                   F.min("doc_id").alias("first_doc"))
              .filter(F.col("n_docs") > limits.min_docs))
    hosts = (_keyed(docs).groupBy("host")
             .agg(F.count_distinct("text_hash").alias("host_docs")))
    return (counts.join(hosts, "host")
            .filter(F.col("n_docs") > F.col("host_docs") * F.lit(limits.share))
            .select("host", "line_hash", "first_doc"))


def removed_lines(docs: DataFrame, limits: LineLimits) -> DataFrame:
    """Per document that loses lines: their hashes and code points."""
    lines = line_rows(docs)
    flagged = frequent_lines(docs, limits)
    hit = (lines.join(flagged, ["host", "line_hash"])
           .filter(~F.col("doc_id").eqNullSafe(F.col("first_doc"))))
    return (hit.groupBy(*KEY)
            .agg(F.collect_set("line_hash").alias("removed_hashes"),
                 F.sum("chars").alias("lost_chars")))


def _line_chars(text: Column) -> Column:
    return F.aggregate(F.split(text, "\n"), F.lit(0).cast("long"),
                       lambda a, x: a + F.length(normal_line(x)))


def judge(docs: DataFrame, limits: LineLimits = LineLimits()) -> DataFrame:
    """Per row of ``docs`` its counts, ``base_failed``, ``lost_chars`` and ``kept``."""
    text = text_or_empty()
    rows = docs.select(
        "doc_id", F.coalesce("source", F.lit("")).alias("host"),
        F.xxhash64(text).alias("text_hash"), *base_columns(text),
        _line_chars(text).alias("line_chars")).select("*", "found.*").drop("found")
    rows = rows.withColumn("base_failed", (F.col("n_words") < 50) | (
        100 * F.col("n_repeat_words") > 50 * F.col("n_words")))
    lost = removed_lines(docs, limits).select(*[F.col(k).alias(f"r_{k}") for k in KEY],
                                              "lost_chars")
    same = [F.col(k).eqNullSafe(F.col(f"r_{k}")) for k in KEY]
    return (rows.join(lost, same, "left")
            .withColumn("lost_chars", F.coalesce("lost_chars", F.lit(0).cast("long")))
            .withColumn("kept", ~F.col("base_failed") & (
                100 * F.col("lost_chars") <= limits.max_lost_percent * F.col("line_chars")))
            .select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines",
                    "n_repeat_words", "base_failed", "lost_chars", "kept"))


def keep_good(docs: DataFrame, limits: LineLimits = LineLimits()) -> DataFrame:
    """The documents that pass, without their removed lines, in the columns of ``docs``.

    ``n_chars``, where there is one, becomes the length of the shortened text.
    """
    text = text_or_empty()
    found = let(words(text), lambda w: F.struct(
        F.size(w).cast("long").alias("n"), repeated_words(w).alias("r")))
    passing = (docs.select(F.struct("*").alias("row"), found.alias("found"))
               .filter("found.n >= 50 AND 100 * found.r <= 50 * found.n")
               .select("row", F.col("row.doc_id").alias("doc_id"),
                       F.coalesce("row.source", F.lit("")).alias("host"),
                       F.xxhash64(text_or_empty("row.text")).alias("text_hash")))
    lost = removed_lines(docs, limits).select(
        *[F.col(k).alias(f"r_{k}") for k in KEY], "removed_hashes", "lost_chars")
    same = [F.col(k).eqNullSafe(F.col(f"r_{k}")) for k in KEY]
    judged = passing.join(lost, same, "left")
    old = F.col("row.text")
    rest = F.when(F.col("removed_hashes").isNull(), old).otherwise(F.array_join(F.filter(
        F.split(old, "\n"), lambda x: ~F.array_contains(
            F.col("removed_hashes"), F.xxhash64(normal_line(x)))), "\n"))
    enough = F.col("lost_chars").isNull() | (
        100 * F.col("lost_chars") <= limits.max_lost_percent * _line_chars(old))
    judged = judged.filter(enough).withColumn("rest", rest)
    replaced = {"text": F.col("rest"), "n_chars": F.length("rest").cast("long")}
    return judged.select(*[replaced[c].alias(c) if c in replaced else F.col("row")[c].alias(c)
                           for c in docs.columns])
