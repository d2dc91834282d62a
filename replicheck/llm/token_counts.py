"""Token counts of texts under a sentencepiece BPE model, without any ids.

A text is cut into units that no merge can cross. In each unit every character is a symbol of a
linked list over positions, and a heap holds the adjacent pairs whose joined text is a piece,
lowest rank first and leftmost among equal ranks. The lowest pair is popped and merged, which
may put its two neighbours' pairs on the heap, until none is left: the count is the number of
initial symbols less the merges. A character that is no piece and was not merged counts as many
tokens as it has UTF-8 bytes. Units are remembered by a task, so frequent words are merged once.

Null texts count as empty; an empty text has no tokens. Repeated rows give equal rows, extra
columns stay away unless ``keep`` names them, and an empty table gives an empty table. Texts of
any length are counted whole.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import astuple, dataclass
from heapq import heapify, heappop, heappush
from struct import unpack

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from replicheck.llm.text import map_batches

#: What stands for a space in pieces.
SPACE = "▁"
#: Distinct units a task remembers, and the longest; a full memory starts anew.
CACHE_UNITS, CACHE_LENGTH = 400_000, 48

# Numbers of fields and kinds in the model file's format.
PIECES, TRAINER, NORMALIZER = 1, 2, 3
PIECE, SCORE, KIND = 1, 2, 3
NORMAL, UNKNOWN, CONTROL, BYTE = 1, 2, 3, 6
MODEL_TYPE, SUFFIX, BYTE_FALLBACK = 3, 24, 35
BPE = 2
CHARS_MAP, DUMMY_PREFIX, EXTRA_SPACES, ESCAPE = 2, 3, 4, 5


@dataclass(frozen=True)
class PieceModel:
    """Mergeable pieces with their ranks (equal scores share one), and how texts begin."""

    ranks: dict[str, int]
    dummy_prefix: bool
    byte_fallback: bool


def _fields(data: bytes) -> Iterator[tuple[int, object]]:
    """Numbers and values of a protocol buffer message's fields."""

    def varint(at: int) -> tuple[int, int]:
        value = shift = 0
        while True:
            value |= (data[at] & 127) << shift
            at, more, shift = at + 1, data[at] & 128, shift + 7
            if not more:
                return value, at

    at = 0
    while at < len(data):
        tag, at = varint(at)
        kind = tag & 7
        if kind == 0:
            value, at = varint(at)
        else:
            size, at = varint(at) if kind == 2 else (8 if kind == 1 else 4, at)
            value, at = data[at : at + size], at + size
        yield tag >> 3, value


def load_pieces(path: str) -> PieceModel:
    """A BPE model whose texts are only marked for spaces. Other kinds of model, pieces that
    users defined or that are switched off, and rewriting of characters are refused."""
    pieces: list[tuple[str, float]] = []
    trainer, normalizer = {}, {}
    with open(path, "rb") as f:
        message = f.read()
    for number, value in _fields(message):
        if number == PIECES:
            piece = dict(_fields(value))
            kind = piece.get(KIND, NORMAL)
            if kind == NORMAL:
                pieces.append((piece[PIECE].decode(), unpack("<f", piece[SCORE])[0]))
            elif kind not in (UNKNOWN, CONTROL, BYTE):
                raise ValueError(f"piece {piece[PIECE]!r} is of kind {kind}")
        elif number == TRAINER:
            trainer = dict(_fields(value))
        elif number == NORMALIZER:
            normalizer = dict(_fields(value))
    if trainer.get(MODEL_TYPE, 1) != BPE or trainer.get(SUFFIX, 0):
        raise ValueError("not a BPE model with spaces before words")
    if normalizer.get(CHARS_MAP) or normalizer.get(EXTRA_SPACES, 1) or not normalizer.get(ESCAPE, 1):
        raise ValueError("the model rewrites its texts")
    places = {s: k for k, s in enumerate(sorted({s for _, s in pieces}, reverse=True))}
    return PieceModel(
        {p: places[s] for p, s in pieces},
        bool(normalizer.get(DUMMY_PREFIX, 1)),
        bool(trainer.get(BYTE_FALLBACK, 0)),
    )


def merge_pairs(unit: str, ranks: dict[str, int]) -> tuple[int, list[int]]:
    """The number of merges in a unit, and where each symbol that is left ends (0 where a
    position starts none)."""
    n = len(unit)
    rank = ranks.get
    heap = [(r, i, i + 2) for i in range(n - 1) if (r := rank(unit[i : i + 2])) is not None]
    heapify(heap)
    after = list(range(1, n + 1))
    before = list(range(-1, n - 1))
    merges = 0
    while heap:
        _, i, end = heappop(heap)
        j = after[i]
        if not j or j >= n or after[j] != end:  # one of the two has been merged since
            continue
        merges += 1
        after[i], after[j] = end, 0
        if end < n:
            before[end] = i
            far = after[end]
            if (r := rank(unit[i:far])) is not None:
                heappush(heap, (r, i, far))
        left = before[i]
        if left >= 0 and (r := rank(unit[left:end])) is not None:
            heappush(heap, (r, left, end))
    return merges, after


class TokenCounter(dict):
    """Counts of units, looked up or merged. Units are runs of characters that occur in pieces
    of several characters; no other character can be merged. Where no piece has a space mark
    behind another character, a unit also ends before each run of space marks."""

    def __init__(self, model: PieceModel):
        self.model = model
        longer = [p for p in model.ranks if len(p) > 1]
        inner = set("".join(longer))
        self.unknown = {c for c in inner if c not in model.ranks}
        chars = "".join(sorted(map(re.escape, inner - {SPACE})))
        apart = not any(re.search(f"[^{SPACE}]{SPACE}", p) for p in longer)
        if chars and apart:
            self.pattern = re.compile(f"{SPACE}*[{chars}]+|{SPACE}+")
        else:
            self.pattern = re.compile(f"[{chars}{SPACE}]+")

    def cost(self, char: str) -> int:
        return 1 if char in self.model.ranks else len(char.encode())

    def __missing__(self, unit: str) -> int:
        merges, after = merge_pairs(unit, self.model.ranks)
        value = len(unit) - merges
        if self.unknown:
            single = (c for i, c in enumerate(unit) if after[i] == i + 1)
            value += sum(self.cost(c) - 1 for c in single if c in self.unknown)
        if len(unit) <= CACHE_LENGTH:
            if len(self) >= CACHE_UNITS:
                self.clear()
            self[unit] = value
        return value

    def count(self, text: str | None) -> int:
        if not text:
            return 0
        marked = (SPACE if self.model.dummy_prefix else "") + text.replace(" ", SPACE)
        total = sum(map(self.__getitem__, self.pattern.findall(marked)))
        alone = Counter(self.pattern.sub("", marked))
        return total + sum(self.cost(c) * k for c, k in alone.items())


def count_tokens(
    docs: DataFrame,
    model: PieceModel,
    limit: int,
    text: str = "text",
    keep: Sequence[str] = ("doc_id",),
) -> DataFrame:
    """``keep`` columns, ``n_bytes`` and ``n_tokens`` of the whole text, and whether it has more
    than ``limit`` tokens (``over_limit``)."""
    if not model.byte_fallback:
        raise ValueError("the model has no byte pieces for unknown characters")
    # plain values: a broadcast object of a class needs the class's module where it is read
    shared = docs.sparkSession.sparkContext.broadcast(astuple(model))
    df = docs.select(*keep, F.col(text).alias("__text"))
    kept = [f for f in df.schema.fields if f.name != "__text"]
    names = [*[f.name for f in kept], "n_bytes", "n_tokens"]
    schema = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in kept)

    def make():
        counter = TokenCounter(PieceModel(*shared.value))

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            texts = batch.column("__text")
            sizes = pc.fill_null(pc.binary_length(texts), 0).cast(pa.int64())
            counts = pa.array(list(map(counter.count, texts.to_pylist())), pa.int64())
            columns = [batch.column(f.name) for f in kept] + [sizes, counts]
            return pa.RecordBatch.from_arrays(columns, names=names)

        return step

    counted = map_batches(df, schema + "n_bytes bigint, n_tokens bigint", make, 200)
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
