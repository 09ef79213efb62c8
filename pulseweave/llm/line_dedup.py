"""Line deduplication by a deletion-neighbourhood join.

Lines are compared as their words with A-Z in lower case.  Two lines are near when they are
equal (at least ``exact_words`` words), or when one unit substituted, inserted or deleted
makes them equal: one word, if both have at least ``near_words`` words; one character of
the words joined by single blanks, if both have fewer words and at least ``near_chars``
characters (none: never).  ``BOUND`` so allows one unit in eight; lines of fewer than eight
characters can only be equal.  Every occurrence of a line that
has an equal or near line earlier in the corpus - smaller doc_id, or same document and
earlier line - is removed; lines are judged on the input.

Equal lines become one class first, by two independent 64-bit hashes, so that a line in a
third of all documents is one row.  Of two near lines either the first or the last halves
are equal; only classes that share such a half with another class emit their deletion
neighbourhood: every variant with one unit left out, as hashed keys.  Equal variants are
joined and verified by a second hash, by length and by the place left out: same length and
same place is one substitution, a whole line against a variant is one insertion.  A group
of equal variants gives each member the group's earliest line, not its pairs.

Documents keep their other lines.  A document that had words and has none left goes; it is
a copy.  Null text stays null, an empty one stays empty.  A null doc_id comes last; rows
with equal doc_id are one document.  Repeated rows are kept or removed alike.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from pulseweave.llm.columns import salted, text_or_empty, written
from pulseweave.llm.exchange import GROUP_BYTES, per_group
from pulseweave.llm.tokens import U64, Words, mix, slices, spans, words_of

LAST = (1 << 63) - 1
SEEDS = (0xA0761D6478BD642F | 3, 0xE7037ED1A0B428DB | 3)


@dataclass(frozen=True)
class EditBound:
    exact_words: int = 1
    near_words: int = 8
    near_chars: int | None = None


#: One edit in eight words or, in shorter lines, in eight characters.
BOUND = EditBound(near_chars=8)


class RangeHash:
    """Hash of any run of consecutive values, from prefix sums with an odd base."""

    def __init__(self, values: np.ndarray, seed: int):
        steps = np.empty((2, len(values) + 1), U64)
        steps[0], steps[1] = U64(seed), U64(pow(seed, -1, 1 << 64))
        steps[:, 0] = 1
        self.power, self.inverse = np.cumprod(steps, axis=1, dtype=U64)
        self.sums = np.concatenate((np.zeros(1, U64), np.cumsum(
            mix(values + U64(seed)) * self.power[:-1], dtype=U64)))

    def raw(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return (self.sums[b] - self.sums[a]) * self.inverse[a]

    def of(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return mix(self.raw(a, b) + (b - a).astype(U64))

    def without(self, a: np.ndarray, i: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Hash of a..b without place i: equals ``of`` the same values in a row."""
        joined = self.raw(a, i) + self.raw(i + 1, b) * self.power[i - a]
        return mix(joined + (b - a - 1).astype(U64))


def lines_of(words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Lines with words: first word, end, and number in the text (split at newlines)."""
    text = words.text
    breaks = np.concatenate(([0], np.cumsum(words.data == 10)))
    number = breaks[words.starts]
    fresh = np.ones(len(number), bool)
    fresh[1:] = (number[1:] != number[:-1]) | (text[1:] != text[:-1])
    first = np.flatnonzero(fresh)
    ends = np.append(first[1:], len(number)) if len(first) else first
    return first, ends, number[first]


def chars_of(words: Words, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Code points of lines (words a to b, joined by single blanks), their starts and ends."""
    n = b - a
    at = np.repeat(a, n) + spans(n)
    size = words.ends[at] - words.starts[at] + 1
    stop = np.cumsum(size)
    data = words.data[np.minimum(np.repeat(words.starts[at], size) + spans(size),
                                 max(0, len(words.data) - 1))]
    data[stop - 1] = 32
    codes = np.frombuffer(data.tobytes().decode().encode("utf-32-le"), "<u4").astype(U64)
    begun = np.concatenate(([0], np.cumsum((data & 0xC0) != 0x80)))
    end = stop[np.cumsum(n) - 1] if len(n) else stop
    start = np.concatenate(([0], end[:-1])) if len(n) else stop
    return codes, begun[start], begun[end] - 1


def _halves(run: RangeHash, a: np.ndarray, b: np.ndarray) -> list[np.ndarray]:
    """Keys of both halves of the line, and of it with one unit less."""
    out = []
    for least in (b - a, b - a - 1):
        half = least // 2
        tag = mix(least.astype(U64))
        out += [run.of(a, a + half) ^ tag, run.of(b - (least - half), b) ^ ~tag]
    return out


def _scan(parts: Iterator[pa.RecordBatch], bound: EditBound) -> Iterator[pa.RecordBatch]:
    for batch in parts:
        for part in slices(batch):
            words = words_of(part.column("text"), lower=True)
            a, b, number = lines_of(words)
            keep = b - a >= bound.exact_words
            a, b, number = a[keep], b[keep], number[keep]
            text = words.text[a]
            # Line numbers count from the text's own first line.
            begin = np.zeros(part.num_rows, np.int64)
            sizes = pa.compute.binary_length(part.column("text")).to_numpy(False)
            np.cumsum(sizes[:-1], out=begin[1:])
            breaks = np.concatenate(([0], np.cumsum(words.data == 10)))
            number = number - breaks[begin][text]
            runs = [RangeHash(words.hashes(), seed) for seed in SEEDS]
            n = b - a
            halves = _halves(runs[0], a, b)
            near = n >= bound.near_words
            if bound.near_chars is not None:
                short = np.flatnonzero(~near)
                codes, c, d = chars_of(words, a[short], b[short])
                near[short] = d - c >= bound.near_chars
                for half, key in zip(halves, _halves(RangeHash(codes, SEEDS[0]), c, d)):
                    half[short] = key
            yield pa.record_batch(
                [pa.array(part.column(c).to_numpy(False)[text])
                 for c in ("grp", "text_hash", "place")]
                + [pa.array(number), pa.array(n.astype(np.int32))]
                + [pa.array(r.of(a, b).view(np.int64)) for r in runs]
                + [pa.array(x.view(np.int64), mask=~near) for x in halves],
                names=["grp", "text_hash", "place", "line", "n", "h1", "h2",
                       "k1", "k2", "k3", "k4"])


LINES = ("grp int, text_hash long, place long, line long, n int, h1 long, h2 long, "
         "k1 long, k2 long, k3 long, k4 long")


def _variants(table: pa.Table, wanted: pa.Table, bound: EditBound) -> pa.Table:
    """Deletion neighbourhoods of a group's wanted lines."""
    out: dict[str, list] = {c: [np.zeros(0, np.int64)] for c in
                            ("v1", "v2", "n", "left_out", "h1", "h2", "place", "line")}
    want = {}
    for row in wanted.to_pylist():
        want.setdefault((row["place"], row["text_hash"]), {})[row["line"]] = row
    for batch in table.to_batches():
        names = list(zip(batch.column("place").to_pylist(), batch.column("text_hash").to_pylist()))
        for i, name in enumerate(names):
            asked = want.pop(name, None)
            if asked is None:
                continue
            words = words_of(batch.column("text").slice(i, 1), lower=True)
            a, b, number = lines_of(words)
            keep = np.isin(number, list(asked))
            a, b, number = a[keep], b[keep], number[keep]
            long = b - a >= bound.near_words
            units = [(words.hashes(), a[long], b[long], number[long])]
            if not long.all():
                units.append((*chars_of(words, a[~long], b[~long]), number[~long]))
            for values, a, b, number in units:
                runs = [RangeHash(values, seed) for seed in SEEDS]
                n = b - a
                line = np.repeat(np.arange(len(a)), n)
                place = np.arange(len(line)) - np.repeat(np.cumsum(n) - n, n)
                for c, r in (("v1", runs[0]), ("v2", runs[1])):
                    out[c] += [r.without(a[line], a[line] + place, b[line]).view(np.int64),
                               r.of(a, b).view(np.int64)]
                out["left_out"] += [place, np.full(len(a), -1)]
                out["n"] += [n[line], n]
                for c in ("h1", "h2", "place", "line"):
                    known = np.array([asked[x][c] for x in number.tolist()], np.int64)
                    out[c] += [known[line], known]
    return pa.table({c: np.concatenate(x).astype(np.int64) for c, x in out.items()})


VARIANTS = ("v1 long, v2 long, n long, left_out long, h1 long, h2 long, place long, line long")


def removed_lines(spark: SparkSession, docs: DataFrame, bound: EditBound) -> tuple[DataFrame, DataFrame]:
    """Documents dealt into groups, and (grp, place, text_hash, line) of removed lines."""
    total = docs.agg(F.sum(F.octet_length("text") + 64)).first()[0] or 0
    groups = max(8, -(-total // GROUP_BYTES))
    text = text_or_empty()
    rows = docs.select(
        F.pmod(F.xxhash64("doc_id", text), F.lit(groups)).cast("int").alias("grp"),
        F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST)).alias("place"),
        F.xxhash64(text).alias("text_hash"), text.alias("text"),
        *[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(docs.columns) if c != "text"],
        F.col("text").isNull().alias("no_text"))
    lines = written(spark, rows.select("grp", "place", "text_hash", "text").mapInArrow(
        lambda parts: _scan(parts, bound), LINES), "lines")
    first = F.min(F.struct("place", "line", "grp", "text_hash")).alias("first")
    # The halves' hashes follow from the words, so as keys they part no class.
    classes = written(spark, lines.groupBy("h1", "h2", "k1", "k2", "k3", "k4").agg(
        first, F.count("*").alias("times")), "line-classes")
    halves = classes.filter("k1 IS NOT NULL").select(
        "h1", F.explode(F.array("k1", "k2", "k3", "k4")).alias("half"))
    one_half = Window.partitionBy("half")
    live = halves.withColumns({"low": F.min("h1").over(one_half),
                               "high": F.max("h1").over(one_half)}).filter("low <> high")
    # h1 alone may take in a class too many here, which the variants then tell apart.
    lively = live.select("h1").distinct()
    wanted = (classes.filter("k1 IS NOT NULL").join(lively, "h1")
              .select(F.col("first.grp").alias("grp"), F.col("first.place").alias("place"),
                      F.col("first.text_hash").alias("text_hash"),
                      F.col("first.line").alias("line"), "h1", "h2"))
    at = F.struct("place", "line")
    # One shuffle by variant serves both kinds of edit.
    same = Window.partitionBy("v1", "v2")
    is_whole = F.col("left_out") < 0
    variants = per_group(rows, wanted, lambda table, some: _variants(table, some, bound),
                         VARIANTS).repartition("v1").withColumns({
        # One substitution: same length, same place left out.
        "swapped": F.min(at).over(Window.partitionBy("v1", "v2", "n", "left_out")),
        # One insertion: a whole line equal to a variant of a line one word longer.
        "whole": F.min(F.when(is_whole, at)).over(same),
        "longer": F.min(F.when(~is_whole, at)).over(same)})
    least = F.when(is_whole, F.col("longer")).otherwise(F.least("swapped", F.coalesce(
        "whole", "swapped")))
    earlier = (variants.withColumn("least", least).filter(F.col("least") < at)
               .groupBy("h1", "h2").agg(F.min("least").alias("least")))
    # Only lines that occur again or have a near line earlier can lose an occurrence.
    again = classes.filter("times > 1").select("h1", "h2", F.struct(
        F.col("first.place").alias("place"), F.col("first.line").alias("line")).alias("least"))
    known = again.union(earlier).groupBy("h1", "h2").agg(F.min("least").alias("least"))
    removed = (salted(lines, known, ["h1", "h2"], F.col("place")).filter(at > F.col("least"))
               .select("grp", "place", "text_hash", "line"))
    return rows, removed


def dedup_lines(spark: SparkSession, docs: DataFrame, bound: EditBound = BOUND) -> DataFrame:
    """``docs`` without removed lines, and without documents left with no words.

    ``n_chars``, where there is one, becomes the length of the shortened text.
    """
    return _rest(spark, docs, bound).filter("NOT gone").select(*docs.columns)


def dedup_report(spark: SparkSession, docs: DataFrame, bound: EditBound = BOUND) -> DataFrame:
    """Per row of ``docs``: doc_id, n_lines, n_removed, kept_sha256 of the rest, gone."""
    found = _rest(spark, docs.select("doc_id", "text"), bound)
    return found.select("doc_id", "n_lines", "n_removed",
                        F.sha2(text_or_empty(), 256).alias("kept_sha256"), "gone")


def _rest(spark: SparkSession, docs: DataFrame, bound: EditBound) -> DataFrame:
    rows, removed = removed_lines(spark, docs, bound)
    marks = ["n_lines", "n_removed", "gone"]
    columns = [c for c in docs.columns if c not in marks]
    kinds = {f.name: f.dataType.simpleString() for f in docs.schema}
    index = {c: f"c{i}" for i, c in enumerate(docs.columns)}

    def work(table: pa.Table, gone: pa.Table) -> pa.Table:
        drop: dict[tuple, set] = {}
        for p, t, n in zip(*(gone.column(c).to_pylist() for c in ("place", "text_hash", "line"))):
            drop.setdefault((p, t), set()).add(n)
        texts, lines, cut, empty = [], [], [], []
        for p, t, text, none in zip(*(table.column(c).to_pylist() for c in (
                "place", "text_hash", "text", "no_text"))):
            all_lines = text.split("\n")
            dropped = drop.get((p, t), ())
            rest = "\n".join(x for i, x in enumerate(all_lines) if i not in dropped) \
                if dropped else text
            texts.append(None if none else rest)
            lines.append(len(all_lines))
            cut.append(len(dropped))
            empty.append(bool(dropped) and not rest.encode().split())
        made = {"text": pa.array(texts, pa.string())}
        shorter = pa.compute.utf8_length(made["text"]).cast(pa.int64())
        names, out = [], []
        for c in columns:
            if c == "text":
                value = made["text"]
            elif c == "n_chars" and kinds[c] == "bigint":
                value = pa.compute.if_else(
                    pa.array([n > 0 for n in cut]), shorter,
                    table.column(index[c]).combine_chunks())
            else:
                value = table.column(index[c])
            names.append(f"o{len(names)}")
            out.append(value)
        out += [pa.array(lines, pa.int64()), pa.array(cut, pa.int64()), pa.array(empty, pa.bool_())]
        return pa.table(out, names=names + marks)

    schema = ", ".join([f"o{i} {kinds[c]}" for i, c in enumerate(columns)]
                       + ["n_lines long", "n_removed long", "gone boolean"])
    found = per_group(rows, removed, work, schema)
    return found.select(*[F.col(f"o{i}").alias(c) for i, c in enumerate(columns)], *marks)
