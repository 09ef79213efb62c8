"""SentencePiece encoding and decoding on the tokenizers library.

The model's protobuf is read field by field; normaliser, metaspace marker, pieces with
their scores (unigram, or merges ordered by score for a BPE model) and byte fallback are
rebuilt as a tokenizers pipeline.

Texts are cut before every run of spaces.  That is exact when no piece has the marker
after another character, which ``rebuild`` checks, and it lets a task encode each distinct
stretch once: new stretches of a slice of texts go to ``encode_batch`` (multithreaded), ids
are gathered from a table per task that is emptied at ``TABLE`` entries.  A model that
fails the check is encoded text by text.

Parity: every new stretch is also encoded by the sentencepiece library; a text has parity
when all its stretches agree.  Decoding joins the pieces' bytes.  Null or empty text: no
ids, parity and round trip hold.  Rows repeat alike; columns other than ids are the
documents' own.
"""

from __future__ import annotations

import os
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from pulseweave.llm.columns import text_or_empty
from pulseweave.llm.tokens import U64, Words, slices

MARK = "▁"
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = range(1, 7)
UNIGRAM, BPE = 1, 2
#: Stretches whose ids a worker keeps, and how many new ones are kept apart before they are
#: sorted in among them.
TABLE, APART = 400_000, 1 << 15
#: Bytes of text, and stretches, that are encoded together.
PART, BATCH = 1 << 19, 1 << 12

ENCODED = "doc_id long, ids array<int>, parity boolean, round_trip boolean"


# --- the model file -------------------------------------------------------------------

def _fields(data: bytes) -> Iterator[tuple[int, object]]:
    """(number, value) of a protobuf message: ints for varints, else bytes."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(data):
        tag = varint()
        kind = tag & 7
        if kind == 0:
            yield tag >> 3, varint()
            continue
        size = {1: 8, 5: 4}.get(kind)
        size = varint() if size is None else size
        yield tag >> 3, data[at:at + size]
        at += size


@dataclass
class Model:
    pieces: list[tuple[str, float, int]] = field(default_factory=list)
    kind: int = UNIGRAM
    byte_fallback: bool = False
    charsmap: bytes = b""
    dummy_prefix: bool = True
    squeeze_spaces: bool = True
    escape_spaces: bool = True


def parse(data: bytes) -> Model:
    """Field numbers are those of the published model format (fixed values)."""
    model = Model()
    for number, value in _fields(data):
        if number == 1:
            piece = dict(_fields(value))
            score = float(np.frombuffer(piece.get(2, bytes(4)), "<f4")[0])
            model.pieces.append((piece[1].decode(), score, piece.get(3, NORMAL)))
        elif number == 2:
            trainer = dict(_fields(value))
            model.kind = trainer.get(3, UNIGRAM)
            model.byte_fallback = bool(trainer.get(35, 0))
        elif number == 3:
            rules = dict(_fields(value))
            model.charsmap = rules.get(2, b"")
            model.dummy_prefix = bool(rules.get(3, 1))
            model.squeeze_spaces = bool(rules.get(4, 1))
            model.escape_spaces = bool(rules.get(5, 1))
    return model


def _merges(model: Model) -> list[tuple[str, str]]:
    """Every way to make a normal piece of two others, best score first."""
    ids = {p: i for i, (p, _, kind) in enumerate(model.pieces) if kind == NORMAL}
    found = []
    for piece, i in ids.items():
        for k in range(1, len(piece)):
            left, right = piece[:k], piece[k:]
            if left in ids and right in ids:
                found.append((-model.pieces[i][1], i, ids[left], ids[right], left, right))
    found.sort()
    return [(f[4], f[5]) for f in found]


def rebuild(model: Model):
    """A tokenizers.Tokenizer for the model."""
    from tokenizers import (AddedToken, Regex, Tokenizer, decoders, models, normalizers,
                            pre_tokenizers)

    unknown = next(i for i, p in enumerate(model.pieces) if p[2] == UNKNOWN)
    if model.kind == UNIGRAM:
        core = models.Unigram([(p, s) for p, s, _ in model.pieces], unk_id=unknown,
                              byte_fallback=model.byte_fallback)
    elif model.kind == BPE:
        core = models.BPE({p: i for i, (p, _, _) in enumerate(model.pieces)}, _merges(model),
                          unk_token=model.pieces[unknown][0], fuse_unk=True,
                          byte_fallback=model.byte_fallback)
    else:
        raise ValueError(f"model type {model.kind} is neither unigram nor BPE")
    made = Tokenizer(core)
    steps = []
    if model.charsmap:
        steps.append(normalizers.Precompiled(model.charsmap))
    if model.squeeze_spaces:
        steps += [normalizers.Strip(), normalizers.Replace(Regex(" {2,}"), " ")]
    if model.dummy_prefix:
        steps.append(normalizers.Prepend(MARK if model.escape_spaces else " "))
    if model.escape_spaces:
        steps.append(normalizers.Replace(" ", MARK))
    if steps:
        made.normalizer = normalizers.Sequence(steps)
    if separable(model):
        made.pre_tokenizer = pre_tokenizers.Split(Regex(f"{MARK}*[^{MARK}]+|{MARK}+"),
                                                  "isolated")
    made.decoder = decoders.Sequence([decoders.Replace(MARK, " "), decoders.ByteFallback(),
                                      decoders.Fuse(), decoders.Strip(" ", 1, 0)])
    users = [AddedToken(p, normalized=False, special=False)
             for p, _, kind in model.pieces if kind == USER]
    if users:
        made.add_tokens(users)
    return made


def separable(model: Model) -> bool:
    """Whether a text can be cut before every run of spaces without other ids."""
    plain = not (model.charsmap or model.squeeze_spaces) and model.escape_spaces \
        and model.dummy_prefix
    return plain and not any(kind == USER or MARK in p.lstrip(MARK)
                             for p, _, kind in model.pieces)


def piece_bytes(model: Model) -> list[bytes]:
    """What each id decodes to; control pieces to nothing."""
    out = []
    for piece, _, kind in model.pieces:
        if kind == BYTE:
            out.append(bytes([int(piece[3:5], 16)]))
        elif kind == CONTROL:
            out.append(b"")
        elif kind == UNKNOWN:
            out.append(" ⁇ ".encode())
        else:
            out.append(piece.replace(MARK, " ").encode())
    return out


def decode(ids: list[int], table: list[bytes], model: Model) -> str:
    text = b"".join(map(table.__getitem__, ids)).decode("utf-8", "replace")
    return text[1:] if model.dummy_prefix and text[:1] == " " else text


# --- in a task ------------------------------------------------------------------------

class Encoder:
    """Encodes slices of texts; holds the ids of the stretches met so far."""

    def __init__(self, data: bytes, verify: bool, backend: str | None = None):
        from tokenizers import Tokenizer

        self.model = parse(data)
        self.backend = Tokenizer.from_str(backend) if backend else rebuild(self.model)
        self.apart = separable(self.model)
        self.other = None
        if verify:
            import sentencepiece
            self.other = sentencepiece.SentencePieceProcessor(model_proto=data)
        self.bytes = piece_bytes(self.model)
        self.clear()

    def clear(self) -> None:
        self.known = [Known.empty(), Known.empty()]

    def plain(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Flat ids of whole texts, ids per text, and where the sentencepiece library gives
        the same; ``BATCH`` texts at a time, whose encodings are dropped before the next."""
        flat, sizes, agree = [np.zeros(0, np.int32)], [], []
        for start in range(0, len(texts), BATCH):
            part = texts[start:start + BATCH]
            ids = [e.ids for e in self.backend.encode_batch_fast(part, add_special_tokens=False)]
            theirs = ids if self.other is None else self.other.encode(part, num_threads=1)
            agree += [a == b for a, b in zip(ids, theirs)]
            sizes += [len(x) for x in ids]
            flat.append(np.fromiter((i for x in ids for i in x), np.int32))
        return np.concatenate(flat), np.array(sizes, np.int64), np.array(agree, bool)

    def _learn(self, keys: np.ndarray, stretches: list[str]) -> None:
        flat, size, agree = self.plain(stretches)
        new = Known(keys, np.concatenate(([0], np.cumsum(size))), flat, agree)
        main, apart = self.known
        if len(main.keys) + len(apart.keys) + len(keys) > TABLE:
            main = apart = Known.empty()
        apart = apart.merged(new)
        if len(apart.keys) > APART:
            main, apart = main.merged(apart), Known.empty()
        self.known = [main, apart]

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Flat ids, ids per text, and parity per text."""
        if not self.apart:
            return self.plain(texts.to_pylist())
        found = stretches_of(texts)
        keys, at, back = np.unique(found.hashes(), return_index=True, return_inverse=True)
        fresh = ~(self.known[0].has(keys) | self.known[1].has(keys))
        if fresh.any():
            if sum(len(k.keys) for k in self.known) + int(fresh.sum()) > TABLE:
                fresh[:] = True  # the table is emptied first
            raw = found.data.tobytes()
            self._learn(keys[fresh], [raw[a:b].decode() for a, b in zip(
                _without_space(found, at[fresh]).tolist(), found.ends[at[fresh]].tolist())])
        here = self.known[0].pick(keys).merged(self.known[1].pick(keys))
        place = np.searchsorted(here.keys, keys)[back]
        size = np.diff(here.first)[place]
        ids = _gather(here.ids, here.first[:-1][place], size)
        ends = np.concatenate(([0], np.cumsum(size)))
        per_text = ends[found.first[1:]] - ends[found.first[:-1]]
        wrong = np.concatenate(([0], np.cumsum(~here.agree[place])))
        return ids, per_text, wrong[found.first[1:]] == wrong[found.first[:-1]]


@dataclass
class Known:
    """Ids of stretches by the sorted hash of the stretch: ids first[i] to first[i + 1]."""
    keys: np.ndarray
    first: np.ndarray
    ids: np.ndarray
    agree: np.ndarray

    @classmethod
    def empty(cls) -> Known:
        return cls(np.zeros(0, U64), np.zeros(1, np.int64), np.zeros(0, np.int32),
                   np.zeros(0, bool))

    def has(self, keys: np.ndarray) -> np.ndarray:
        if not len(self.keys):
            return np.zeros(len(keys), bool)
        near = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return self.keys[near] == keys

    def pick(self, keys: np.ndarray) -> Known:
        """Those of the sorted ``keys`` that are known."""
        keys = keys[self.has(keys)]
        at = np.searchsorted(self.keys, keys)
        size = np.diff(self.first)[at]
        return Known(keys, np.concatenate(([0], np.cumsum(size))),
                     _gather(self.ids, self.first[:-1][at], size), self.agree[at])

    def merged(self, other: Known) -> Known:
        if not len(self.keys) or not len(other.keys):
            return other if not len(self.keys) else self
        keys = np.concatenate((self.keys, other.keys))
        order = np.argsort(keys, kind="stable")
        size = np.concatenate((np.diff(self.first), np.diff(other.first)))
        begin = np.concatenate((self.first[:-1], len(self.ids) + other.first[:-1]))
        return Known(keys[order], np.concatenate(([0], np.cumsum(size[order]))),
                     _gather(np.concatenate((self.ids, other.ids)), begin[order], size[order]),
                     np.concatenate((self.agree, other.agree))[order])


def _gather(values: np.ndarray, begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """values[begin:begin + size] of every pair, one after the other."""
    total = int(size.sum())
    shift = np.repeat(begin - (np.cumsum(size) - size), size)
    return values[np.arange(total) + shift]


def _without_space(found: Words, at: np.ndarray) -> np.ndarray:
    """Starts without one space, which the dummy prefix stands for."""
    return found.starts[at] + 1


def stretches_of(texts: pa.Array) -> Words:
    """Stretches that begin with a run of spaces; each text is given one space in front,
    where the encoder puts the dummy prefix.  Empty texts have none."""
    texts = texts.cast(pa.large_string())
    _, bounds, values = texts.buffers()
    at = np.frombuffer(bounds, np.int64)[texts.offset:texts.offset + len(texts) + 1]
    raw = np.frombuffer(values, np.uint8)[at[0]:at[-1]] if values is not None \
        else np.zeros(0, np.uint8)
    size = np.diff(at)
    some = size > 0
    begin = np.concatenate(([0], np.cumsum(size + some)))
    data = np.full(int(begin[-1]), 32, np.uint8)
    inner = np.ones(len(data), bool)
    inner[begin[:-1][some]] = False
    data[inner] = raw
    space = data == 32
    start = space.copy()
    start[1:] &= ~space[:-1]
    # One space at the end of a text stays with the stretch before it.
    start[begin[1:][some] - 1] = False
    start[begin[:-1][some]] = True
    starts = np.flatnonzero(start)
    ends = np.append(starts[1:], len(data)) if len(starts) else starts
    return Words(data, starts, ends, np.searchsorted(starts, begin))


def encode(docs: DataFrame, model: bytes, threads: int = 2, verify: bool = True) -> DataFrame:
    """Per row of ``docs``: doc_id, ids, parity with sentencepiece, and whether the ids
    decode to the text.  ``model`` is the model file's bytes; the pipeline is rebuilt once
    and shipped with the tasks (a few MB, fixed by the model)."""
    backend = rebuild(parse(model)).to_str()

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        os.environ["TOKENIZERS_PARALLELISM"] = "true"
        os.environ["RAYON_NUM_THREADS"] = str(threads)
        encoder = Encoder(model, verify, backend)
        for batch in batches:
            for part in slices(batch, size=PART):
                texts = part.column("text")
                ids, size, agree = encoder.encode(texts)
                first = np.concatenate(([0], np.cumsum(size)))
                back = [decode(ids[a:b].tolist(), encoder.bytes, encoder.model)
                        for a, b in zip(first[:-1], first[1:])]
                same = [a == b for a, b in zip(back, texts.to_pylist())]
                yield pa.record_batch([
                    part.column("doc_id"),
                    pa.ListArray.from_arrays(pa.array(first, pa.int32()), pa.array(ids)),
                    pa.array(agree), pa.array(same)],
                    names=["doc_id", "ids", "parity", "round_trip"])

    # The marker itself is written as a space, which the model cannot tell from it.
    text = F.replace(text_or_empty(), F.lit(MARK), F.lit(" "))
    return docs.select(F.col("doc_id").cast("long"), text.alias("text")).mapInArrow(scan, ENCODED)
