"""Repair of conversation structure by iterative deepening A*.

A conversation is well formed if its roles' initials read ``(s?(ua)+)?``.  The cheapest
edits lead there: Keep (0), Rerole to user or assistant (2), Delete (3, forced for blank and
repeated rows) and Insert of an empty row (2); a truncated row that stays adds 1.  Of the
cheapest edits those whose initials D, I, K, R come first in ASCII order are taken.

The search goes depth first in the order D, I, K, R under a bound on cost so far plus a
lower bound of the rest; a table keeps the largest budget with which a state (row, place in
the pattern) has failed.  The bound grows to the least sum that exceeded it, so that the
first path accepted is the answer.

A conversation may hold any share of the rows: rows are numbered by ranges
(``positions``) and searched in chunks of ``CHUNK`` rows.  The pattern has four places, so a
chunk's cheapest costs from each place to each are 16 numbers; they are added up from the last
chunk to the first, and a chunk's search from each place then counts what follows
it.  What is left for one conversation is one pass over its rows in order, which a digest of
its text needs anyway; that pass keeps one row, the edits of a chunk, and the edits'
initials, which are a value of the result.

``conversations`` has conv_id, turn, role, text.  A null role or text is one space (so a null
text is blank); a null turn is first and a space in the damage key; null conv_ids are one
conversation.  Rows of one turn are ordered by role and then by the text's sha256;
repeated rows are damaged alike.  A conversation without rows has cost 0.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from pulseweave.llm.columns import BLANKS, salted, written
from pulseweave.llm.positions import numbered

CHUNK = 16
TASK_CHUNKS = 256  # a task's chunks, as long as there are enough tasks
DELETE, INSERT, KEEP, REROLE = "DIKR"
COST = {DELETE: 3, INSERT: 2, KEEP: 0, REROLE: 2}
TRUNCATED_COST = 1
#: Places in the pattern: nothing yet, after s, after u, after a.
START, S, U, A = range(4)
#: Where Insert or Rerole leads, and the role that it gives.
NEXT = {START: U, S: U, U: A, A: U}
ROLE = {U: "user", A: "assistant"}
#: Cheapest inserts after the last row, by place.
TAIL = {START: "", S: "II", U: "I", A: ""}
FAULTS = {"blank": "b", "duplicate": "d", "truncated": "t", "": "-"}


# --- the search -----------------------------------------------------------------------

def _forced(code: str) -> bool:
    return code[0] in "bd"


def _kept(place: int, initial: str) -> int | None:
    """Where Keep leads, None if the pattern forbids it."""
    if initial == "s":
        return S if place == START else None
    if initial == "u":
        return U if place != U else None
    return A if initial == "a" and place == U else None


@lru_cache(maxsize=None)
def _moves(code: str, place: int) -> tuple[tuple[str, int, int, int], ...]:
    """The edits of a row in ASCII order: (edit, rows consumed, place, cost)."""
    stays = TRUNCATED_COST if code[0] == "t" else 0
    moves = [(DELETE, 1, place, COST[DELETE]), (INSERT, 0, NEXT[place], COST[INSERT])]
    if not _forced(code):
        kept = _kept(place, code[1])
        if kept is not None:
            moves.append((KEEP, 1, kept, COST[KEEP] + stays))
        moves.append((REROLE, 1, NEXT[place], COST[REROLE] + stays))
    return tuple(moves)


def _least_cost(code: str) -> int:
    return (COST[DELETE] if _forced(code) else TRUNCATED_COST if code[0] == "t" else 0)


@lru_cache(maxsize=1 << 14)
def search(codes: str, entry: int, after: tuple) -> tuple[int, str, int] | None:
    """(cost, edits, last place) of the best edits of a chunk, all its rows consumed.

    ``codes`` has a fault and an initial per row; ``after`` the cost of what follows, by
    last place, None where it cannot be."""
    rows = [codes[i:i + 2] for i in range(0, len(codes), 2)]
    n = len(rows)
    # The start is left for good, and s is only reached from it by a row that is kept.
    first_s = entry == S or entry == START and any(
        r[1] == "s" and not _forced(r) for r in rows)
    after = (after[0] if entry == START else None, after[1] if first_s else None, *after[2:])
    open_after = [x for x in after if x is not None]
    if not open_after:
        return None
    floor = [0] * n + [min(open_after)]
    for i in range(n - 1, -1, -1):
        floor[i] = floor[i + 1] + _least_cost(rows[i])
    far = 1 << 60
    bound, beyond = floor[0], far
    failed: dict[tuple[int, int], int] = {}
    path: list[str] = []

    def walk(i: int, place: int, budget: int) -> int | None:
        """Last place of the first accepted path within ``budget``."""
        nonlocal beyond
        if i == n:
            rest = after[place]
            if rest is not None and rest <= budget:
                return place
            if rest is not None:
                beyond = min(beyond, rest - budget)
            return None
        if failed.get((i, place), -1) >= budget:
            return None
        for edit, rows_used, then, cost in _moves(rows[i], place):
            left = budget - cost
            if floor[i + rows_used] > left:
                beyond = min(beyond, floor[i + rows_used] - left)
                continue
            path.append(edit)
            last = walk(i + rows_used, then, left)
            if last is not None:
                return last
            path.pop()
        failed[(i, place)] = budget
        return None

    while True:
        last = walk(0, entry, bound)
        if last is not None:
            return bound, "".join(path), last
        # The table holds within one bound: there a state's first failure has told what it lacks.
        failed.clear()
        bound, beyond = bound + beyond, far


def _through(codes: str) -> list[list[int | None]]:
    """Cheapest cost of a chunk from each place to each."""
    def one(entry: int, goal: int) -> int | None:
        found = search(codes, entry, tuple(0 if g == goal else None for g in range(4)))
        return found and found[0]
    return [[one(e, g) for g in range(4)] for e in range(4)]


END = tuple(COST[INSERT] * len(TAIL[place]) for place in range(4))


# --- rows and faults ------------------------------------------------------------------

def damaged(conversations: DataFrame) -> DataFrame:
    """(grp, conv_id, turn, role, text) after the damage; ``grp`` is never null."""
    space = F.lit(" ")
    text, role = F.coalesce("text", space), F.coalesce("role", space)
    key = F.concat_ws(":", F.coalesce(F.col("conv_id").cast("string"), space),
                      F.coalesce(F.col("turn").cast("string"), space))
    hit = F.crc32(key) % 20
    rows = conversations.select(
        group_of("conv_id").alias("grp"), "conv_id", "turn", role.alias("role"),
        text.alias("text"), hit.alias("hit")).filter("hit <> 0")
    return rows.select(
        "grp", "conv_id", "turn", F.when(F.col("hit") == 4, "user").otherwise(F.col("role"))
        .alias("role"),
        F.when(F.col("hit") == 1, "").when(
            F.col("hit") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
        .alias("text"),
        F.explode(F.when(F.col("hit") == 3, F.array(F.lit(0), F.lit(1)))
                  .otherwise(F.array(F.lit(0)))).alias("copy"))


def group_of(name: str) -> Column:
    return F.coalesce(F.concat(F.lit("="), F.col(name).cast("string")), F.lit(""))


def faults(spark: SparkSession, rows: DataFrame) -> DataFrame:
    """``rows`` in order: position, chunk, members, and ``code``, a fault and an initial."""
    rows = rows.withColumn("digest", F.sha2("text", 256))
    placed = written(spark, numbered(spark, rows, "grp", ["turn", "role", "digest", "copy"],
                                     "conversation-rows"), "conversation-places")
    # Only (role, text) pairs that repeat go on; a pair is one row after the partial sums.
    said = placed.groupBy("grp", "role", "digest").agg(
        F.min("position").alias("first"), F.count("*").alias("n")).filter("n > 1").drop("n")
    again = written(spark, salted(
        placed.select("grp", "role", "digest", "position"), said, ["grp", "role", "digest"],
        F.col("position")).filter("position > first").select(
            "grp", "position", F.lit(True).alias("again")), "conversation-repeats")
    end = F.substring(F.rtrim(F.col("text"), F.lit(BLANKS)), -1, 1)
    fault = (F.when(end == "", FAULTS["blank"])
             .when(F.col("again"), FAULTS["duplicate"])
             .when(~end.isin(".", "!", "?"), FAULTS["truncated"]).otherwise(FAULTS[""]))
    initial = F.rpad(F.substring("role", 1, 1), 1, " ")
    return placed.join(again, ["grp", "position"], "left").select(
        "grp", "conv_id", "turn", "role", "text", "members", "position",
        F.floor(F.col("position") / CHUNK).alias("chunk"),
        F.concat(fault, F.when(initial.isin("s", "u", "a"), initial).otherwise("?"))
        .alias("code"))


# --- chunks ---------------------------------------------------------------------------

AFTER = "a0 long, a1 long, a2 long, a3 long"
OPTIONS = pa.schema([("grp", pa.string()), ("chunk", pa.int64()), ("options", pa.list_(
    pa.struct([("edits", pa.string()), ("cost", pa.int64()), ("last", pa.int32())])))])
OPTIONS_TYPE = "grp string, chunk long, options array<struct<edits:string,cost:long,last:int>>"


def _costs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The cheapest costs through every chunk, entry by entry."""
    for batch in batches:
        costs = [sum(_through(codes), []) for codes in batch.column("codes").to_pylist()]
        yield pa.record_batch([batch.column("grp"), batch.column("chunk"),
                               pa.array(costs, pa.list_(pa.int64()))],
                              names=["grp", "chunk", "costs"])


def _sum_back(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What follows each chunk, of chunks sorted from the last of a conversation to the first."""
    grp, after = None, END
    for batch in batches:
        out = []
        for g, costs in zip(batch.column("grp").to_pylist(), batch.column("costs").to_pylist()):
            if g != grp:
                grp, after = g, END
            out.append(after)
            after = tuple(min((c + a for c, a in zip(costs[4 * e:4 * e + 4], after)
                               if c is not None and a is not None), default=None)
                          for e in range(4))
        yield pa.record_batch(
            [batch.column("grp"), batch.column("chunk"),
             *[pa.array([row[k] for row in out], pa.int64()) for k in range(4)]],
            names=["grp", "chunk", "a0", "a1", "a2", "a3"])


def _options(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The best edits of every chunk from each place; a first chunk starts at the start."""
    for batch in batches:
        out = []
        for chunk, codes, *after in zip(*(batch.column(c).to_pylist() for c in
                                          ("chunk", "codes", "a0", "a1", "a2", "a3"))):
            made = []
            for entry in range(4 if chunk else 1):
                found = search(codes, entry, tuple(after))
                made.append(found and {"cost": found[0] - after[found[2]], "edits": found[1],
                                       "last": found[2]})
            out.append(made)
        yield pa.record_batch([batch.column("grp"), batch.column("chunk"),
                               pa.array(out, OPTIONS.field("options").type)], schema=OPTIONS)


def options(spark: SparkSession, rows: DataFrame) -> DataFrame:
    """(grp, chunk, options) of every chunk of ``rows`` with faults."""
    chunks = written(spark, rows.groupBy("grp", "chunk").agg(
        F.first("members").alias("members"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("position", "code"))),
                                 lambda x: x["code"]), "").alias("codes")),
        "conversation-chunks")
    # The search is work per row, not per byte: spread it further than the bytes call for.
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    tasks = max(1, min(tasks, chunks.count() // TASK_CHUNKS))
    chunks = chunks.repartition(tasks, "grp", "chunk")
    one = chunks.filter(F.col("members") <= CHUNK).select(
        "*", *[F.lit(c).cast("long").alias(f"a{k}") for k, c in enumerate(END)])
    many = chunks.filter(F.col("members") > CHUNK)
    through = written(spark, many.mapInArrow(_costs, "grp string, chunk long, costs array<long>"),
                      "conversation-costs")
    follow = (through.repartition("grp").sortWithinPartitions("grp", F.desc("chunk"))
              .mapInArrow(_sum_back, f"grp string, chunk long, {AFTER}"))
    columns = ["grp", "chunk", "codes", "a0", "a1", "a2", "a3"]
    return one.select(columns).union(many.join(follow, ["grp", "chunk"]).select(columns)) \
        .repartition(tasks, "grp", "chunk").mapInArrow(_options, OPTIONS_TYPE)


# --- the pass over a conversation -----------------------------------------------------

RESULT = ("conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, "
          "cost long, audit string, repaired_sha256 string")
#: Adjacent initials that are in order.
LEGAL = ("su", "ua", "au")
COUNTED = {"b": 1, "d": 2, "t": 3}


class Conversation:
    """State of the pass: counts, place in the pattern, and the digest so far."""

    def __init__(self, conv_id):
        self.conv_id = conv_id
        self.counts = [0, 0, 0, 0, 0, 0]  # gaps, blank, duplicate, truncated, illegal, cost
        self.audit, self.place, self.edits = [], START, iter(())
        self.digest, self.lines = hashlib.sha256(), 0
        self.first_turn = self.last_turn = self.before = None
        self.turns = 0

    def emit(self, role: str, text: str) -> None:
        self.digest.update((("\n" if self.lines else "") + f"{role}:{text}").encode())
        self.lines += 1

    def insert(self) -> None:
        self.place = NEXT[self.place]
        self.emit(ROLE[self.place], "")

    def chunk(self, options: list) -> None:
        chosen = options[self.place]
        self.audit.append(chosen["edits"])
        self.counts[5] += chosen["cost"]
        self.edits = iter(chosen["edits"])

    def row(self, turn, role: str, text: str, code: str) -> None:
        if code[0] in COUNTED:
            self.counts[COUNTED[code[0]]] += 1
        pair = None if self.before is None else self.before + role[:1]
        self.counts[4] += pair is not None and pair not in LEGAL
        self.before = role[:1]
        if turn is not None and turn != self.last_turn:
            self.turns += 1
            self.first_turn = turn if self.first_turn is None else self.first_turn
            self.last_turn = turn
        for edit in self.edits:
            if edit == INSERT:
                self.insert()
                continue
            if edit == KEEP:
                self.place = _kept(self.place, role[:1])
                self.emit(role, text)
            elif edit == REROLE:
                self.place = NEXT[self.place]
                self.emit(ROLE[self.place], text)
            break

    def result(self) -> tuple:
        tail = TAIL[self.place]
        self.audit.append(tail)
        self.counts[5] += COST[INSERT] * len(tail)
        for _ in tail:
            self.insert()
        if self.turns:
            self.counts[0] = self.last_turn - self.first_turn + 1 - self.turns
        return self.conv_id, *map(int, self.counts), "".join(self.audit), self.digest.hexdigest()


RESULT_SCHEMA = pa.schema(
    [("conv_id", pa.int64())] + [(n, pa.int64()) for n in
                                 ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    + [("audit", pa.string()), ("repaired_sha256", pa.string())])


def _pass(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Conversations in order: a head, then per chunk its options and its rows."""
    grp, now = None, None
    columns = ("grp", "kind", "conv_id", "turn", "role", "text", "code", "options")
    for batch in batches:
        out = []
        for g, kind, conv_id, turn, role, text, code, options in zip(
                *(batch.column(c).to_pylist() for c in columns)):
            if g != grp or now is None:
                if now is not None:
                    out.append(now.result())
                grp, now = g, Conversation(conv_id)
            if kind == 1:
                now.chunk(options)
            elif kind == 2:
                now.row(turn, role, text, code)
        yield pa.RecordBatch.from_pylist([dict(zip(RESULT_SCHEMA.names, r)) for r in out],
                                         RESULT_SCHEMA)
    if now is not None:
        yield pa.RecordBatch.from_pylist([dict(zip(RESULT_SCHEMA.names, now.result()))],
                                         RESULT_SCHEMA)


def repair(spark: SparkSession, conversations: DataFrame, damage: bool = True) -> DataFrame:
    """One row per conversation: counts of faults, the cheapest edits, and a digest of the
    repaired rows.  Without ``damage`` the rows are taken as they are."""
    rows = damaged(conversations) if damage else conversations.select(
        group_of("conv_id").alias("grp"), "conv_id", "turn",
        F.coalesce("role", F.lit(" ")).alias("role"),
        F.coalesce("text", F.lit(" ")).alias("text"), F.lit(0).alias("copy"))
    found = written(spark, faults(spark, rows), "conversation-faults")
    heads = conversations.select(group_of("conv_id").alias("grp"), "conv_id").distinct()

    def stream(frame: DataFrame, kind: int) -> DataFrame:
        types = {"grp": "string", "chunk": "long", "position": "long", "conv_id": "long",
                 "turn": "long", "role": "string", "text": "string", "code": "string",
                 "options": OPTIONS_TYPE.split("options ")[1]}
        return frame.select(F.lit(kind).alias("kind"), *[
            (F.col(n) if n in frame.columns else F.lit(None)).cast(t).alias(n)
            for n, t in types.items()])

    ordered = (stream(heads.withColumn("chunk", F.lit(-1)), 0)
               .union(stream(options(spark, found), 1)).union(stream(found, 2))
               .repartition("grp").sortWithinPartitions("grp", "chunk", "kind", "position"))
    return ordered.mapInArrow(_pass, RESULT)
