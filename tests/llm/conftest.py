import random
import re

import pytest

SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, "
          "row string, host string, text_hash string, grp string, size string, h1 string, "
          "held string, line string, pii_kinds string, c0 string")


@pytest.fixture(scope="session")
def corpus(spark):
    """Documents of the given (doc_id, text) or (doc_id, text, source) rows, with extra
    columns whose names operators use inside."""
    def build(rows):
        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "src0",
                 None if r[1] is None else len(r[1]), *["x"] * 10) for r in rows]
        return spark.createDataFrame(full, SCHEMA)
    return build


@pytest.fixture(scope="session")
def awkward():
    """Null, empty, blank and very long texts, ties, repeated rows, null ids and sources."""
    long = " ".join(f"w{i % 997} the of" for i in range(30_000))
    line = "one two three four five six seven eight nine ten eleven twelve"
    return [(1, None), (2, ""), (3, " \n\t "), (4, "word"), (5, long), (6, line), (6, line),
            (7, line), (8, line.replace("six", "SIX")), (None, line), (None, None),
            (9, "\n".join([line] * 40)), (10, "ünïcode ▁ 漢字 🦙 \x00 end "),
            (11, line, None), (5, line)]


@pytest.fixture(scope="session")
def mixed():
    """Small texts with many shared passages: copies, edits, reordered parts."""
    rng = random.Random(7)
    words = [rng.choice("abcdefgh") * rng.randint(1, 3) + str(rng.randint(0, 60))
             for _ in range(300)]
    passages = [" ".join(rng.choices(words, k=rng.randint(5, 60))) for _ in range(12)]
    rows = []
    for i in range(120):
        parts = [" ".join(rng.choices(words, k=rng.randint(0, 25))) for _ in range(3)]
        parts += rng.choices(passages, k=rng.randint(0, 3))
        rng.shuffle(parts)
        text = "\n".join(parts)
        if i % 5 == 0 and i:
            text = rows[i // 2][1].replace("a", "b", rng.randint(0, 2))
        rows.append((i * 3 % 121, text, f"src{i % 3}"))
    return rows


@pytest.fixture(scope="session")
def split_words():
    return lambda text: re.findall(r"[^\x20\x09-\x0D]+", text or "")


@pytest.fixture(scope="session")
def low():
    table = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return lambda text: text.translate(table)
