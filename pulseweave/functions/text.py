"""Text expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Fixed value: form of a window key, unit@start/end in brackets.
WINDOW_KEY_PATTERN = r"^\[(.*?)@(.*?)/(.*?)\]$"


def window_key(unit: Column, start_ms: Column, end_ms: Column) -> Column:
    return F.format_string("[%s@%d/%d]", unit, start_ms, end_ms)


def is_window_key(key: Column) -> Column:
    return key.rlike(WINDOW_KEY_PATTERN)


def window_key_part(key: Column, part: int) -> Column:
    """1 is the unit, 2 the start, 3 the end."""
    return F.regexp_extract(key, WINDOW_KEY_PATTERN, part)


def unit_label(unit: Column) -> Column:
    """``a/b`` shown as ``a / b``."""
    return F.replace(unit, F.lit("/"), F.lit(" / "))


def ngrams(text: Column, shortest: int = 3, longest: int = 8) -> Column:
    """Distinct lower-case n-grams of one text value, as an array.

    The array is bounded by the length of the value (186 grams for a UUID with
    the default sizes), not by the data.
    """
    lowered = F.lower(text)

    def of_length(n: int) -> Column:
        count = F.length(text) - F.lit(n - 1)
        starts = F.when(count >= 1, F.sequence(F.lit(1), count)).otherwise(
            F.array().cast("array<int>"))
        return F.transform(starts, lambda i: F.substring(lowered, i, F.lit(n)))

    return F.array_distinct(F.concat(*[of_length(n) for n in range(shortest, longest + 1)]))
