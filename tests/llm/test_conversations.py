"""Conversation repair against a plain dynamic program over whole conversations."""

import hashlib
import random
import re
import zlib

import pytest

from pulseweave.llm import conversations

BLANKS = " \t\n\x0b\x0c\r"
NEXT = {"": "u", "s": "u", "u": "a", "a": "u"}
NAMES = {"u": "user:", "a": "assistant:"}
SCHEMA = "conv_id long, turn long, role string, text string, chunk string, code string"


def hurt(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        hit = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
                         .encode()) % 20
        if hit == 0:
            continue
        text = "" if hit == 1 else re.sub("[.!?]", "", text) if hit == 2 else text
        out += [(turn, "user" if hit == 4 else role, text)] * (2 if hit == 3 else 1)
    return sorted(out, key=lambda x: (x[0] is not None, x[0] or 0, x[1],
                                      hashlib.sha256(x[2].encode()).hexdigest()))


def plain(conv, rows):
    rows = hurt(rows)
    faults, seen = [], set()
    for _, role, text in rows:
        bare = text.rstrip(BLANKS)
        faults.append("b" if not bare else "d" if (role, text) in seen
                      else "t" if bare[-1] not in ".!?" else "-")
        seen.add((role, text))
    turns = [r[0] for r in rows if r[0] is not None]
    # Cheapest (cost, edits) from each row and place, last row first.
    best = {"": (0, ""), "a": (0, ""), "u": (2, "I"), "s": (4, "II")}
    for (_, role, _), fault in zip(reversed(rows), reversed(faults)):
        now = {}
        for place in NEXT:
            ways = [(3, "D", place)]
            if fault in "-t":
                stays = fault == "t"
                if place in {"s": [""], "u": ["", "s", "a"], "a": ["u"]}.get(role[:1], []):
                    ways.append((stays, "K", role[:1]))
                ways.append((2 + stays, "R", NEXT[place]))
            now[place] = min((c + best[p][0], e + best[p][1]) for c, e, p in ways)
        for _ in range(4):
            now = {p: min(now[p], (2 + now[NEXT[p]][0], "I" + now[NEXT[p]][1])) for p in NEXT}
        best = now
    cost, audit = best[""]
    place, lines, left = "", [], iter(rows)
    for edit in audit:
        row = None if edit == "I" else next(left)
        if edit == "K":
            place = row[1][:1]
            lines.append(f"{row[1]}:{row[2]}")
        elif edit in "IR":
            place = NEXT[place]
            lines.append(NAMES[place] + (row[2] if row else ""))
    return (conv, max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0,
            *(faults.count(f) for f in "bdt"),
            sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:])),
            cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(5)
    out = []
    for conv in range(80):
        for turn in range(rng.choice([1, 2, 3, 5, 8, 12, 30])):
            for _ in range(rng.choice([1, 1, 1, 2])):
                text = rng.choice(["a.", "b", "", " \t", "c!", "x?\n"]) + rng.choice(["", f"{turn}."])
                out.append((None if conv % 9 == 0 and turn % 3 == 0 else conv,
                            rng.choice([turn] * 9 + [None]),
                            rng.choice(["user", "assistant", "system", "tool", "u", None, ""]),
                            None if rng.random() < .05 else text))
    return out + out[:7]


@pytest.mark.parametrize("chunk", [conversations.CHUNK, 4])
def test_plain_program(spark, rows, monkeypatch, chunk):
    """In one chunk and in chunks of four rows alike."""
    monkeypatch.setattr(conversations, "CHUNK", chunk)
    frame = spark.createDataFrame([(*r, "x", "y") for r in rows], SCHEMA)
    found = {r.conv_id: tuple(r) for r in conversations.repair(spark, frame).collect()}
    wanted = {c: plain(c, [r for r in rows if r[0] == c]) for c in {r[0] for r in rows}}
    assert found == wanted


def test_one_conversation_holds_most_rows(spark):
    """3,000 rows of one conversation, many equal, over 188 chunks."""
    rng = random.Random(1)
    rows = [(1, i, rng.choice(["user", "assistant"]), rng.choice(["same.", f"{i}", f"{i}."]))
            for i in range(3000)]
    frame = spark.createDataFrame([(*r, "x", "y") for r in rows], SCHEMA)
    assert [tuple(r) for r in conversations.repair(spark, frame).collect()] == [plain(1, rows)]


def test_nothing_left(spark):
    """A conversation whose only row is dropped, and an empty table."""
    conv = next(c for c in range(100) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    frame = spark.createDataFrame([(conv, 0, "user", "a.", "x", "y")], SCHEMA)
    empty = hashlib.sha256(b"").hexdigest()
    assert [tuple(r) for r in conversations.repair(spark, frame).collect()] == [
        (conv, 0, 0, 0, 0, 0, 0, "", empty)]
    assert conversations.repair(spark, frame.limit(0)).collect() == []


def test_very_long_text_and_without_damage(spark):
    frame = spark.createDataFrame([(1, 0, "user", "w " * 200_000 + "end.", "x", "y"),
                                   (1, 1, "assistant", "ok.", "x", "y")], SCHEMA)
    assert conversations.repair(spark, frame, damage=False).first().audit == "KK"
