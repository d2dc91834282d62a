"""Byte-level BPE encoding and decoding by rank files.

Encoding splits a text by the tokenizer's pattern and merges the bytes of every piece. The
merge loop keeps a segment tree over byte positions: leaf ``i`` holds the rank of the pair that
starts at the live token ``i`` (with ``i`` itself as tie-break), inner nodes hold the smallest
leaf below, so the root is the leftmost pair of lowest rank. A merge changes the leaves of the
merged token, of the token it swallowed and of the live left neighbour, each one path to the
root. Pieces of up to ``FOREST_BYTES`` bytes are merged side by side, one tree each, in numpy.

Null texts count as empty; an empty text has no ids. Repeated rows give equal rows, extra
columns stay away unless ``keep`` names them, and an empty table gives an empty table.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from replicheck.llm.text import map_batches

#: Pieces up to this length share vectorised trees; longer ones get a tree of their own.
FOREST_BYTES = 64
#: Distinct units a task remembers; a full memory keeps those it met again.
CACHE_UNITS = 120_000
#: White space as the pattern's \s has it.
SPACE = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
NONE = np.iinfo(np.int64).max


def load_ranks(path: str) -> list[bytes]:
    """Byte strings by id from a rank file (base64 and rank on each line)."""
    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
    table = [b""] * (max(ranks.values()) + 1)
    for token, i in ranks.items():
        table[i] = token
    return table


class Merges:
    """Which two tokens make which token: every split of a token into two tokens counts."""

    def __init__(self, table: Sequence[bytes]):
        self.ids = {t: i for i, t in enumerate(table) if t}
        self.first = np.array([self.ids.get(bytes([b]), -1) for b in range(256)], np.int64)
        self.scalar = {
            (self.ids[t[:k]] << 32) | self.ids[t[k:]]: i
            for t, i in self.ids.items()
            for k in range(1, len(t))
            if t[:k] in self.ids and t[k:] in self.ids
        }
        n = len(self.scalar)
        keys, made = np.fromiter(self.scalar.keys(), np.int64, n), np.fromiter(self.scalar.values(), np.int64, n)
        order = np.argsort(keys)
        self.keys = keys[order] if n else np.array([-1], np.int64)
        self.made = made[order] if n else np.array([0], np.int64)

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = (left << 32) | right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.made[at], NONE)


def merge_one(piece: bytes, merges: Merges) -> list[int]:
    """Ids of one piece of any length, by one segment tree."""
    if (whole := merges.ids.get(piece)) is not None:
        return [whole]
    n = len(piece)
    width = 1 << max(1, (n - 1).bit_length())
    token = [int(merges.first[b]) for b in piece]
    after = list(range(1, n + 1))
    before = list(range(-1, n - 1))
    rank = merges.scalar.get
    none = int(NONE)

    def leaf(i: int) -> int:
        j = after[i]
        r = rank((token[i] << 32) | token[j]) if j < n else None
        return none if r is None else r * width + i

    tree = [none] * (2 * width)
    for i in range(n):
        tree[width + i] = leaf(i)
    for k in range(width - 1, 0, -1):
        tree[k] = min(tree[2 * k], tree[2 * k + 1])

    def put(i: int, value: int) -> None:
        k = width + i
        tree[k] = value
        while k > 1:
            k >>= 1
            low = min(tree[2 * k], tree[2 * k + 1])
            if tree[k] == low:
                break
            tree[k] = low

    while tree[1] != none:
        made, i = divmod(tree[1], width)
        j = after[i]
        token[i] = made
        after[i] = after[j]
        if after[j] < n:
            before[after[j]] = i
        put(j, none)
        put(i, leaf(i))
        if before[i] >= 0:
            put(before[i], leaf(before[i]))
    out, i = [], 0
    while i < n:
        out.append(token[i])
        i = after[i]
    return out


def merge_forest(pieces: list[bytes], merges: Merges) -> tuple[np.ndarray, np.ndarray]:
    """All ids of many pieces of 2 to FOREST_BYTES bytes behind each other, and their number by
    piece; one segment tree a piece, merged in step."""
    m = len(pieces)
    lengths = np.fromiter(map(len, pieces), np.int64, m)
    w = 1 << max(1, int(lengths.max() - 1).bit_length())
    flat = np.frombuffer(b"".join(pieces), np.uint8)
    row = np.repeat(np.arange(m), lengths)
    col = np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    token = np.zeros((m, w + 1), np.int64)
    token[row, col] = merges.first[flat]
    after = np.broadcast_to(np.arange(1, w + 2), (m, w + 1)).copy()
    before = np.broadcast_to(np.arange(-1, w), (m, w + 1)).copy()

    def leaves(r: np.ndarray, i: np.ndarray) -> np.ndarray:
        j = after[r, i]
        rank = merges.ranks(token[r, i], token[r, np.minimum(j, w)])
        return np.where((j < lengths[r]) & (rank != NONE), rank * w + i, NONE)

    tree = np.full((m, 2 * w), NONE)
    tree[row, w + col] = leaves(row, col)
    for k in range(w - 1, 0, -1):
        tree[:, k] = np.minimum(tree[:, 2 * k], tree[:, 2 * k + 1])

    def put(r: np.ndarray, i: np.ndarray, values) -> None:
        k = w + i
        tree[r, k] = values
        while k[0] > 1:
            k = k >> 1
            tree[r, k] = np.minimum(tree[r, 2 * k], tree[r, 2 * k + 1])

    live = np.flatnonzero(tree[:, 1] != NONE)
    gone_row, gone = [], []
    while len(live):
        made, i = np.divmod(tree[live, 1], w)
        j = after[live, i]
        gone_row.append(live)
        gone.append(j)
        token[live, i] = made
        end = after[live, j]
        after[live, i] = end
        before[live, np.minimum(end, w)] = i
        put(live, j, NONE)
        put(live, i, leaves(live, i))
        left = before[live, i]
        has = left >= 0
        if has.any():
            put(live[has], left[has], leaves(live[has], left[has]))
        live = live[tree[live, 1] != NONE]
    alive = np.zeros((m, w + 1), bool)
    alive[row, col] = True
    alive[np.concatenate([row[:0], *gone_row]), np.concatenate([col[:0], *gone])] = False
    return token[alive], alive.sum(1)


def ragged(values: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """``values[start : start + size]`` of every start and size, behind each other."""
    before = np.cumsum(sizes) - sizes
    return values[np.arange(int(sizes.sum())) + np.repeat(starts - before, sizes)]


class Store:
    """Runs of integers by number, kept behind each other."""

    def __init__(self):
        self.number: dict = {}
        self.values = np.empty(0, np.int32)
        self.starts = np.empty(0, np.int64)
        self.sizes = np.empty(0, np.int32)
        self.uses = np.empty(0, np.int32)

    def add(self, keys: Sequence, values: np.ndarray, sizes: np.ndarray) -> None:
        at = len(self.sizes)
        self.number.update(zip(keys, range(at, at + len(keys))))
        starts = len(self.values) + np.cumsum(sizes) - sizes
        self.values = np.concatenate((self.values, np.asarray(values, np.int32)))
        self.starts = np.concatenate((self.starts, starts))
        self.sizes = np.concatenate((self.sizes, np.asarray(sizes, np.int32)))
        self.uses = np.concatenate((self.uses, np.zeros(len(keys), np.int32)))

    def get(self, numbers: np.ndarray) -> np.ndarray:
        return ragged(self.values, self.starts[numbers], self.sizes[numbers])

    def use(self, numbers: np.ndarray) -> None:
        self.uses += np.bincount(numbers, minlength=len(self.uses)).astype(np.int32)

    def used_again(self) -> Store:
        """A store of what was used more than once; nothing, where that is more than half."""
        out, again = Store(), np.flatnonzero(self.uses > 1)
        if 2 * len(again) <= len(self.uses):
            keys = list(self.number)  # in the order of their numbers
            out.add([keys[i] for i in again.tolist()], self.get(again), self.sizes[again])
        return out


def merge_into(store: Store, pieces: Sequence[str], merges: Merges) -> None:
    """Store the ids of new pieces."""
    classes: dict[int, list[str]] = {}
    for p in pieces:
        b = p.encode()
        whole = merges.ids.get(b)
        kind = 0 if whole is not None else (len(b) - 1).bit_length() if len(b) <= FOREST_BYTES else -1
        classes.setdefault(kind, []).append(p)
    for kind, group in classes.items():
        for at in range(0, len(group), 4096):
            part = group[at : at + 4096]
            if kind > 0 and len(part) >= 16:
                store.add(part, *merge_forest([p.encode() for p in part], merges))
            else:
                ids = [merge_one(p.encode(), merges) for p in part]
                sizes = np.fromiter(map(len, ids), np.int64, len(ids))
                store.add(part, np.array([i for x in ids for i in x], np.int32), sizes)


class Encoder:
    """Ids of texts. A text is cut into units, each one optional space and what follows up to
    the next white space, or a run of white space: every cut is also a cut of the pattern
    (which never joins white space to what follows but for one space), so units are split and
    merged on their own and remembered. Most units are met once: a full memory keeps the others."""

    def __init__(self, table: Sequence[bytes], pattern: str):
        self.merges = Merges(table)
        self.pattern = regex.compile(pattern)
        s = f"[{SPACE}]"
        self.find_units = re.compile(rf" ?[^{SPACE}]+|{s}+(?!{'[^' + SPACE + ']'})|{s}+").findall
        self.units = Store()

    def learn(self, new: list[str]) -> None:
        """Split and merge units that are not in the store yet."""
        spaced = [u for u in new if len(u) > 1 and u[0] == " " and not u.isspace()]
        chosen = set(spaced)
        other = [u for u in new if u not in chosen]
        found = self.pattern.findall("".join(spaced))  # a unit's first piece has its only space
        split = [self.pattern.findall(u) for u in other]
        starts = [k for k, p in enumerate(found) if p[0] == " "] + [len(found)]
        counts = [b - a for a, b in zip(starts, starts[1:])] + list(map(len, split))
        pieces = found + [p for x in split for p in x]
        merged = Store()
        merge_into(merged, list(set(pieces)), self.merges)
        numbers = np.fromiter(map(merged.number.__getitem__, pieces), np.int64, len(pieces))
        before = np.concatenate(([0], np.cumsum(merged.sizes[numbers])))
        ends = np.cumsum(np.array(counts, np.int64))
        sizes = np.diff(before[np.concatenate(([0], ends))])
        self.units.add(spaced + other, merged.get(numbers), sizes)

    def batch(self, texts: Sequence[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """All ids behind each other, and where each text's ids start (one more than texts)."""
        if len(self.units.number) > CACHE_UNITS:
            self.units = self.units.used_again()
        per_text = [self.find_units(t) if t else [] for t in texts]
        units = [u for x in per_text for u in x]
        known = self.units.number
        if new := [u for u in set(units) if u not in known]:
            self.learn(new)
        numbers = np.fromiter(map(known.__getitem__, units), np.int64, len(units))
        self.units.use(numbers)
        ends = np.concatenate(([0], np.cumsum(self.units.sizes[numbers], dtype=np.int64)))
        text_ends = np.concatenate(([0], np.cumsum(list(map(len, per_text)), dtype=np.int64)))
        return self.units.get(numbers), ends[text_ends]


def encode(
    docs: DataFrame,
    table: Sequence[bytes],
    pattern: str,
    text: str = "text",
    keep: Sequence[str] = ("doc_id",),
) -> DataFrame:
    """``keep`` columns and ``ids`` (array of int): the tokens of every whole text."""
    shared = docs.sparkSession.sparkContext.broadcast((list(table), pattern))
    df = docs.select(*keep, F.col(text).alias("__text"))
    kept = [f for f in df.schema.fields if f.name != "__text"]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept) + ", ids array<int>"

    def make():
        encoder = Encoder(*shared.value)

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            flat, ends = encoder.batch(batch.column("__text").to_pylist())
            ids = pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(flat))
            names = [f.name for f in kept]
            return pa.RecordBatch.from_arrays(
                [batch.column(n) for n in names] + [ids], names=[*names, "ids"]
            )

        return step

    return map_batches(df, schema, make, 200)


def decode(encoded: DataFrame, table: Sequence[bytes], ids: str = "ids") -> DataFrame:
    """All columns and ``decoded`` (binary): the bytes that the ids stand for. Null ids give
    null; an id that the table lacks fails."""
    shared = encoded.sparkSession.sparkContext.broadcast(list(table))
    fields = encoded.schema.fields
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields) + ", decoded binary"

    def make():
        get = shared.value.__getitem__

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            column = batch.column(ids)
            at, flat = column.offsets.to_numpy(), column.values.to_numpy(zero_copy_only=False)
            valid = column.is_valid().to_pylist()
            out = [
                b"".join(map(get, flat[a:b].tolist())) if ok else None
                for a, b, ok in zip(at[:-1], at[1:], valid)
            ]
            return pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(out, pa.binary())],
                names=[*batch.schema.names, "decoded"],
            )

        return step

    return map_batches(encoded, schema, make, 200)


def digests(docs: DataFrame, table: Sequence[bytes], pattern: str) -> DataFrame:
    """Per document: number of ids, SHA-256 of the ids in decimal joined by commas, SHA-256 of
    the decoded bytes."""
    done = decode(encode(docs, table, pattern), table)
    return done.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ",").cast("binary"), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
