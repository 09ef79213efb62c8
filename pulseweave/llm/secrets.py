"""Secret scan by grammar inference.

Three base patterns find credentials in whole texts (kinds ``assign``, ``access``, ``hex``).
What they find is the labelled data: per kind at most ``sample`` distinct values, those with
the smallest hashes, and as many ordinary runs of credential characters.  Each set becomes a
prefix tree over character classes whose states are merged while their outgoing and stopping
frequencies agree within a Hoeffding bound, which gives a probabilistic automaton per kind.
Every run of at least ``shortest`` credential characters, less what base spans cover, is a
candidate, whatever its mix of letters, digits and dots; the log-likelihood of its format under the best kind, less that
under ordinary runs, is its score, and candidates from ``threshold`` on are added as spans of
kind ``grammar``.

The labelled samples (bounded by ``sample``) are all that reaches the driver; the automata
are fitted there and go to the tasks.  Positions are code points, ends exclusive.  Null or
empty text: no spans.  Repeated rows give equal rows.  Without labelled values there are no
``grammar`` spans.
"""

from __future__ import annotations

import hashlib
import heapq
import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, functions as F

from pulseweave.llm.columns import text_or_empty, written

# The base patterns.
ASSIGN = re.compile(r"""((?ai:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?"""
                    r"""([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")
BASE_KINDS = ("assign", "access", "hex")
HINTS = ("password", "passwd", "secret", "token", "apikey", "api_key")

# Dots join parts of a run and never end one.
RUN = re.compile(r"[A-Za-z0-9+/_=-]+(?:\.+[A-Za-z0-9+/_=-]+)*")
OUT = ("doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, "
       "spans string, n_grammar long")


@dataclass(frozen=True)
class Inference:
    sample: int = 1000
    shortest: int = 8
    confidence: float = 0.05
    threshold: float = 10.0


def base_spans(text: str) -> list[tuple[int, int, str, str]]:
    """(start, end, kind, credential) of the base patterns, by start and then kind."""
    found = []
    low = text.lower()
    if any(h in low for h in HINTS):
        found += [(m.start(), m.end(), 0, m[2]) for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    if "AKIA" in text:
        found += [(m.start(), m.end(), 1, m[0]) for m in ACCESS.finditer(text) if len(m[0]) >= 16]
    # A run of 32 or more is a whole run: a search cannot begin inside one.
    found += [(m.start(), m.end(), 2, m[0]) for m in HEX.finditer(text)]
    return [(a, b, BASE_KINDS[k], v) for a, b, k, v in sorted(found)]


def candidates(text: str, spans: list[tuple], shortest: int) -> Iterator[tuple[int, int, str]]:
    """Runs of ``shortest`` characters or more, and what base spans leave of them."""
    for m in RUN.finditer(text):
        at, end = m.span()
        if end - at < shortest:
            continue
        for s, e, *_ in [*(x for x in spans if x[0] < end and at < x[1]), (end, end)]:
            # A part begins and ends without dots, like a run.
            part = text[at:s].strip(".")
            if len(part) >= shortest:
                a = text.index(part, at)
                yield a, a + len(part), part
            at = max(at, e)


# --- automata -------------------------------------------------------------------------

CLASSES = {"digit": "0123456789", "low hex": "abcdef", "low": "ghijklmnopqrstuvwxyz",
           "high hex": "ABCDEF", "high": "GHIJKLMNOPQRSTUVWXYZ", "base64": "+/", "pad": "=",
           "under": "_", "dash": "-", "dot": "."}
CLASS_OF = {c: i for i, chars in enumerate(CLASSES.values()) for c in chars}
SPREAD = [-math.log(len(chars)) for chars in CLASSES.values()]
UNSEEN = math.log(1e-4)


class State:
    """Stops here, and per symbol [next state, uses of the arc]."""

    def __init__(self) -> None:
        self.stops = 0
        self.arcs: dict[int, list] = {}

    @property
    def count(self) -> int:
        return self.stops + sum(uses for _, uses in self.arcs.values())

    def uses(self, symbol: int) -> int:
        return self.arcs[symbol][1] if symbol in self.arcs else 0


def prefix_tree(values: list[str]) -> State:
    root = State()
    for value in values:
        state = root
        for c in value:
            arc = state.arcs.setdefault(CLASS_OF[c], [None, 0])
            arc[0] = arc[0] or State()
            arc[1] += 1
            state = arc[0]
        state.stops += 1
    return root


def _differ(a: int, of_a: int, b: int, of_b: int, confidence: float) -> bool:
    """Hoeffding bound on the difference of two observed frequencies."""
    bound = math.sqrt(math.log(2 / confidence) / 2) * (of_a ** -0.5 + of_b ** -0.5)
    return abs(a / of_a - b / of_b) > bound


def compatible(a: State, b: State, confidence: float) -> bool:
    """Whether a state and the root of a tree have like frequencies, all the way down."""
    todo = [(a, b)]
    while todo:
        x, y = todo.pop()
        n, m = x.count, y.count
        if _differ(x.stops, n, y.stops, m, confidence):
            return False
        for symbol in x.arcs.keys() | y.arcs.keys():
            if _differ(x.uses(symbol), n, y.uses(symbol), m, confidence):
                return False
        todo += [(x.arcs[s][0], y.arcs[s][0]) for s in x.arcs.keys() & y.arcs.keys()]
    return True


def _fold(into: State, tree: State) -> None:
    """Add a tree's counts to an automaton, and the branches that it lacks."""
    todo = [(into, tree)]
    while todo:
        a, b = todo.pop()
        a.stops += b.stops
        for symbol, (child, uses) in b.arcs.items():
            if symbol in a.arcs:
                a.arcs[symbol][1] += uses
                todo.append((a.arcs[symbol][0], child))
            else:
                a.arcs[symbol] = [child, uses]


def merged(root: State, confidence: float) -> list[State]:
    """The states left when every state has joined the first kept one it is like."""
    kept = [root]
    while True:
        inside = {id(k) for k in kept}
        border = [(k, s) for k in kept for s in sorted(k.arcs) if id(k.arcs[s][0]) not in inside]
        if not border:
            return kept
        parent, symbol = max(border, key=lambda x: x[0].uses(x[1]))
        state = parent.arcs[symbol][0]
        like = next((k for k in kept if compatible(k, state, confidence)), None)
        if like is None:
            kept.append(state)
        else:
            parent.arcs[symbol][0] = like
            _fold(like, state)


class Automaton:
    """A probabilistic automaton inferred from labelled values."""

    def __init__(self, values: list[str], confidence: float):
        kept = merged(prefix_tree(values), confidence)
        number = {id(k): i for i, k in enumerate(kept)}
        self.arcs = [{s: (number[id(t)], math.log(uses / k.count))
                      for s, (t, uses) in k.arcs.items()} for k in kept]
        self.stop = [math.log(k.stops / k.count) if k.stops else UNSEEN for k in kept]

    def log_likelihood(self, value: str) -> float:
        state, total = 0, 0.0
        for c in value:
            symbol = CLASS_OF[c]
            arc = self.arcs[state].get(symbol)
            if arc is None:
                total += UNSEEN + SPREAD[symbol]
            else:
                state = arc[0]
                total += arc[1] + SPREAD[symbol]
        return total + self.stop[state]


def score(value: str, kinds: list[Automaton], ordinary: Automaton) -> float:
    return max(k.log_likelihood(value) for k in kinds) - ordinary.log_likelihood(value)


# --- over a corpus --------------------------------------------------------------------

def _hash(value: str) -> int:
    return xxhash.xxh64_intdigest(value.encode()) >> 1


def labelled(spark: SparkSession, docs: DataFrame, rule: Inference) -> dict[str, list[str]]:
    """Per kind, and for ordinary runs under '', the ``sample`` values of least hash."""
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: dict[str, set] = {k: set() for k in (*BASE_KINDS, "")}
            for text in batch.column("text"):
                text = text.as_py()
                spans = base_spans(text)
                for _, _, kind, value in spans:
                    found[kind].add(value)
                # Words as well as mixed runs: what a credential must be told from.
                found[""].update(run for _, _, run in candidates(text, spans, rule.shortest))
            rows = [(k, v, h) for k, values in found.items()
                    for h, v in heapq.nsmallest(rule.sample, ((_hash(v), v) for v in values))]
            yield pa.record_batch([pa.array([r[i] for r in rows], t) for i, t in enumerate(
                (pa.string(), pa.string(), pa.int64()))], names=["kind", "value", "h"])

    rows = written(spark, docs.select(text_or_empty().alias("text")).mapInArrow(
        scan, "kind string, value string, h long"), "labelled")
    return {kind: [r.value for r in rows.filter(F.col("kind") == kind).select("value", "h")
                   .distinct().orderBy("h", "value").limit(rule.sample).collect()]
            for kind in (*BASE_KINDS, "")}


def infer(labels: dict[str, list[str]], rule: Inference) -> tuple[list[Automaton], Automaton | None]:
    """An automaton per kind that has values, and the one of ordinary runs."""
    kinds = [Automaton(labels[k], rule.confidence) for k in BASE_KINDS if labels[k]]
    ordinary = labels[""] or ["x" * rule.shortest]
    return kinds, Automaton(ordinary, rule.confidence) if kinds else None


def _joined(spans: list[tuple]) -> str:
    return ",".join(f"{kind}:{a}:{b}" for a, b, kind, *_ in spans)


def scan_secrets(spark: SparkSession, docs: DataFrame, rule: Inference = Inference()) -> DataFrame:
    """Per row of ``docs``: counts of base spans, their digest, all spans, n_grammar."""
    kinds, ordinary = infer(labelled(spark, docs, rule), rule)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
                text = text.as_py()
                base = base_spans(text)
                added = [(a, b, "grammar") for a, b, run in candidates(text, base, rule.shortest)
                         if score(run, kinds, ordinary) >= rule.threshold] if kinds else []
                n = [sum(s[2] == k for s in base) for k in BASE_KINDS]
                every = sorted([*base, *added], key=lambda s: (
                    s[0], BASE_KINDS.index(s[2]) if s[2] in BASE_KINDS else len(BASE_KINDS)))
                rows.append((doc_id, *n, hashlib.sha256(_joined(base).encode()).hexdigest(),
                             _joined(every), len(added)))
            names = [x.split()[0] for x in OUT.split(", ")]
            types = [pa.string() if x.endswith("string") else pa.int64() for x in OUT.split(", ")]
            yield pa.record_batch([pa.array([r[i] for r in rows], t)
                                   for i, t in enumerate(types)], names=names)

    return docs.select(F.col("doc_id").cast("long"), text_or_empty().alias("text")).mapInArrow(
        scan, OUT)
