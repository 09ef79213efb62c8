"""Line deduplication of lines with few words, against brute force."""

import random

from pulseweave.llm import line_dedup


def one_edit(a, b):
    if abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    long, short = (a, b) if len(a) > len(b) else (b, a)
    return any(long[:i] + long[i + 1:] == short for i in range(len(long)))


def test_short_lines(spark, corpus, split_words, low):
    rng = random.Random(4)
    base = ["Les.", "And ornd.", "a", "b", "x y", "über 漢字 maß", "one two three four",
            "12:30 Menu 7", "home about contact us", "seven words are in this short line"]
    rows = []
    for i in range(80):
        lines = []
        for _ in range(rng.randint(1, 3)):
            line = list(rng.choice(base))
            for _ in range(rng.choice([0, 0, 1, 1, 2])):
                at = rng.randrange(len(line))
                line[at:at + rng.randint(0, 1)] = rng.choice(["", "e", "字", " ", "Z"])
            lines.append(rng.choice(["", " "]) + "".join(line))
        rows.append((i * 7 % 83, "\n".join(lines)))
    seen, gone, near = [], {}, 0
    for place, text in sorted(rows):
        for line in text.split("\n"):
            words = split_words(low(line))
            if not words:
                continue
            assert len(words) < line_dedup.BOUND.near_words or "this" in line
            joined = " ".join(words)
            equal = joined in seen
            close = any(one_edit(joined, x) and min(len(joined), len(x)) >= 8
                        and max(len(words), len(x.split())) < 8 for x in seen)
            close = close or any(one_edit(words, split_words(x)) for x in seen
                                 if min(len(words), len(split_words(x))) >= 8)
            near += close and not equal
            gone[place] = gone.get(place, 0) + (equal or close)
            seen.append(joined)
    assert near > 10
    found = {r.doc_id: r.n_removed for r in line_dedup.dedup_report(spark, corpus(rows)).collect()}
    assert found == {place: gone.get(place, 0) for place, _ in rows}
