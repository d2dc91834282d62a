"""Ranked search of all documents for every item, by the words that they share.

Documents are read once for a block of items: a task cuts texts into terms and keeps, for every
document, how many terms it has and which of the block's terms how often. Those narrow rows are
staged; counts over them give each term's weight. Ranking then works on shards of the staged
rows. For one item, bitmaps of its terms over the shard's documents give each document the mask
of the terms it holds, and documents of one mask form a group. No document of a group can score
more than the sum of the best contributions that its terms make anywhere in the shard, so groups
are scored in descending order of that bound until the bound falls below the item's last place.
What a task has found for an item carries over to its next shard. A window merges the tasks'
lists, ``k`` rows an item and task.

Items come in blocks of about ``BLOCK_BYTES`` of terms, so what the driver and the tasks hold of
them does not grow with their number; each block reads the documents once.

A null text has no terms. Rows that repeat an id, or lack one, are documents of their own; among
equal scores rows without an id come last. Every row of the items is ranked, also one that
repeats another; an item without terms, or whose terms no document holds, gives no rows. Other
columns are not read. Empty tables give an empty table.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from replicheck.llm.bpe import ragged
from replicheck.llm.text import give_back, map_batches
from replicheck.sources import Workspace

#: What separates terms, as a pattern's class; only A-Z are lower-cased.
APART = r"\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Bytes of terms in a block of items, postings of a shard, bytes of masks held at once.
BLOCK_BYTES, SHARD_POSTINGS, MASK_BYTES = 4_000_000, 2_000_000, 32_000_000
#: Documents scored at once, at least, while the next groups' bounds allow it.
SCORED = 64

#: The same for bytes: those of terms in lower case, a space for all others.
TERM_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256)
)


@dataclass(frozen=True)
class Block:
    """Items of a block with the numbers of their terms, and the terms' weights."""

    items: np.ndarray
    terms: list[np.ndarray]
    weights: np.ndarray


def distinct_terms(items: DataFrame, text: str) -> DataFrame:
    """``(no, item_id, terms)`` of every item; ``no`` tells rows apart."""
    lowered = F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)
    terms = F.array_distinct(F.regexp_extract_all(lowered, F.lit(f"[^{APART}]+"), F.lit(0)))
    return items.select(F.monotonically_increasing_id().alias("no"), "item_id", terms.alias("terms"))


def index(docs: DataFrame, vocabulary: list[str], text: str) -> DataFrame:
    """``(doc_id, n, terms, tfs)`` of every document with a term: their number, and which of the
    vocabulary it holds how often."""
    shared = docs.sparkSession.sparkContext.broadcast({t.encode(): k for k, t in enumerate(vocabulary)})
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col(text).cast("binary").alias("text"))

    def make():
        number = shared.value.get
        size = max(len(shared.value), 1)

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            words = [t.translate(TERM_BYTES).split() if t else [] for t in batch.column("text").to_pylist()]
            n = np.fromiter(map(len, words), np.int64, len(words))
            found = np.fromiter(map(number, chain.from_iterable(words), repeat(-1)), np.int64, int(n.sum()))
            row = np.repeat(np.arange(len(words)), n)[found >= 0]
            posting, tf = np.unique(row * size + found[found >= 0], return_counts=True)
            row, term = np.divmod(posting, size)
            some = n > 0
            ends = np.concatenate(([0], np.cumsum(np.bincount(row, minlength=len(words))[some])))
            offsets = pa.array(ends.astype(np.int32))
            return pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").filter(pa.array(some)),
                    pa.array(n[some]),
                    pa.ListArray.from_arrays(offsets, pa.array(term.astype(np.int32))),
                    pa.ListArray.from_arrays(offsets, pa.array(tf.astype(np.int32))),
                ],
                names=["doc_id", "n", "terms", "tfs"],
            )

        return step

    return map_batches(rows, "doc_id bigint, n bigint, terms array<int>, tfs array<int>", make)


class Shard:
    """Postings of some documents, by document and by term, with what each adds to a score."""

    def __init__(self, parts: list[pa.RecordBatch], weights: np.ndarray, count: int, length: int):
        table = pa.Table.from_batches(parts).combine_chunks()
        ids = table["doc_id"].chunk(0)
        self.absent = np.asarray(ids.is_null())
        self.ids = ids.fill_null(0).to_numpy(zero_copy_only=False)
        n = table["n"].to_numpy()
        lists = table["terms"].chunk(0)
        ends = lists.offsets.to_numpy().astype(np.int64)
        self.starts, self.sizes = ends[:-1] - ends[0], np.diff(ends)
        self.term = lists.flatten().to_numpy(zero_copy_only=False)
        tf = table["tfs"].chunk(0).flatten().to_numpy(zero_copy_only=False).astype(np.int64)
        document = np.repeat(np.arange(len(n)), self.sizes)
        m = (10 + 90 * n * count // length)[document]
        self.adds = weights[self.term] * (1_000_000_000 * tf // (1000 * tf + 8 * m))
        order = np.argsort(self.term, kind="stable")
        self.document = document[order]
        at = np.searchsorted(self.term[order], np.arange(len(weights) + 1))
        self.first, self.last = at[:-1], at[1:]
        self.best = np.zeros(len(weights), np.int64)
        held = np.flatnonzero(self.last > self.first)
        if len(held):
            self.best[held] = np.maximum.reduceat(self.adds[order], self.first[held])
        self.wanted = np.zeros(len(weights), bool)

    def groups(self, terms: np.ndarray, low: int, high: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Documents from ``low`` to ``high`` that hold a term, sorted by mask, where each mask's
        documents start, and the masks' bounds."""
        masks = np.zeros((-(-len(terms) // 64), high - low), np.uint64)
        for k, t in enumerate(terms):
            holders = self.document[self.first[t] : self.last[t]]
            if high - low < len(self.ids):
                holders = holders[np.searchsorted(holders, low) : np.searchsorted(holders, high)]
            masks[k // 64, holders - low] |= np.uint64(1 << k % 64)
        order = np.flatnonzero(masks.any(0))
        order = order[np.lexsort(masks[:, order]) if len(masks) > 1 else np.argsort(masks[0, order])]
        masks = masks[:, order]
        cut = np.ones(len(order), bool)
        cut[1:] = (masks[:, 1:] != masks[:, :-1]).any(0)
        starts = np.flatnonzero(cut)
        masks = masks[:, starts]
        bounds = np.zeros(len(starts), np.int64)
        for k, t in enumerate(terms):
            has = masks[k // 64] >> np.uint64(k % 64) & np.uint64(1)
            bounds += has.astype(np.int64) * self.best[t]
        return order + low, starts, bounds

    def scores(self, documents: np.ndarray, terms: np.ndarray) -> np.ndarray:
        """What the item's terms add up to in each document; each holds one at least."""
        sizes = self.sizes[documents]
        at = self.starts[documents]
        self.wanted[terms] = True
        adds = ragged(self.adds, at, sizes) * self.wanted[ragged(self.term, at, sizes)]
        self.wanted[terms] = False
        return np.add.reduceat(adds, np.cumsum(sizes) - sizes)


class Best:
    """The best ``k`` documents found so far for an item, best first."""

    def __init__(self, k: int):
        self.k = k
        self.scores, self.ids, self.absent = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)

    def out_of_reach(self, bound: int) -> bool:
        return bound <= 0 or (len(self.scores) == self.k and bound < self.scores[-1])

    def add(self, scores: np.ndarray, ids: np.ndarray, absent: np.ndarray) -> None:
        good = scores > 0
        scores = np.concatenate((self.scores, scores[good]))
        ids, absent = np.concatenate((self.ids, ids[good])), np.concatenate((self.absent, absent[good]))
        order = np.lexsort((ids, absent, -scores))[: self.k]
        self.scores, self.ids, self.absent = scores[order], ids[order], absent[order]


def rank_item(shard: Shard, terms: np.ndarray, best: Best) -> int:
    """Put the shard's best documents for an item among those known. Returns how many documents
    were scored."""
    terms = terms[shard.best[terms] > 0]
    if not len(terms) or best.out_of_reach(int(shard.best[terms].sum())):
        return 0
    scored = 0
    step = max(SCORED, MASK_BYTES // (8 * -(-len(terms) // 64)))
    for low in range(0, len(shard.ids), step):
        documents, starts, bounds = shard.groups(terms, low, min(low + step, len(shard.ids)))
        sizes = np.diff(starts, append=len(documents))
        order = np.argsort(-bounds, kind="stable")
        ends = np.cumsum(sizes[order])
        at = 0
        while at < len(order) and not best.out_of_reach(int(bounds[order[at]])):
            end = int(np.searchsorted(ends, (ends[at - 1] if at else 0) + SCORED)) + 1
            groups = order[at:end]
            if len(best.scores) == best.k:
                groups = groups[bounds[groups] >= best.scores[-1]]
            chosen = ragged(documents, starts[groups], sizes[groups])
            best.add(shard.scores(chosen, terms), shard.ids[chosen], shard.absent[chosen])
            scored += len(chosen)
            at = end
    return scored


def rank_block(rows: DataFrame, block: Block, count: int, length: int, k: int) -> DataFrame:
    """``(no, doc_id, score)``: up to ``k`` documents for each item from every task."""
    # plain values: a broadcast object of a class needs the class's module where it is read
    shared = rows.sparkSession.sparkContext.broadcast((block.items, block.terms, block.weights))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = Block(*shared.value)
        best = [Best(k) for _ in block.items]

        def rank(parts: list[pa.RecordBatch]) -> None:
            shard = Shard(parts, block.weights, count, length)
            for terms, found in zip(block.terms, best):
                rank_item(shard, terms, found)

        parts, size = [], 0
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                parts.append(part)
                size += part.num_rows + len(part.column("terms").flatten())
                if size >= SHARD_POSTINGS:
                    rank(parts)
                    parts, size = [], 0
        if parts:
            rank(parts)
        no = np.repeat(block.items, [len(b.scores) for b in best])
        ids, absent, scores = (
            np.concatenate([empty, *[getattr(b, name) for b in best]])
            for name, empty in (("ids", block.items[:0]), ("absent", np.zeros(0, bool)), ("scores", block.items[:0]))
        )
        yield pa.RecordBatch.from_pydict(
            {"no": pa.array(no), "doc_id": pa.array(ids, mask=absent), "score": pa.array(scores)}
        )
        parts = best = None
        give_back()

    return rows.mapInArrow(run, "no bigint, doc_id bigint, score bigint")


def search(docs: DataFrame, items: DataFrame, k: int = 10, text: str = "text") -> DataFrame:
    """``(item_id, rank, doc_id, score)``: each item's ``k`` best documents with a score above
    0, equal scores by ascending id."""
    ws = Workspace(docs.sparkSession)
    queries = ws.stage(distinct_terms(items, text), "items")
    terms = F.aggregate("terms", F.lit(0).cast("bigint"), lambda a, t: a + F.octet_length(t) + 1)
    total = queries.agg(F.sum(terms)).first()[0] or 0
    blocks = 1 if total <= BLOCK_BYTES else math.ceil(2 * total / BLOCK_BYTES)
    found = []
    for b in range(blocks):
        own = queries.filter((F.size("terms") > 0) & (F.pmod(F.xxhash64("no"), F.lit(blocks)) == b))
        listed = own.select("no", "terms").toArrow()
        if not listed.num_rows:
            continue
        column = listed["terms"].combine_chunks()
        coded = column.flatten().dictionary_encode()
        ends = column.offsets.to_numpy().astype(np.int64)
        numbers = coded.indices.to_numpy().astype(np.int64)
        each = [numbers[a:z] for a, z in zip(ends[:-1] - ends[0], ends[1:] - ends[0])]
        vocabulary = coded.dictionary.to_pylist()
        rows = ws.stage(index(docs, vocabulary, text), "index")
        count, length = rows.agg(F.count("*"), F.sum("n")).first()
        if not count:
            break
        holders = rows.select(F.explode("terms").alias("term")).groupBy("term").count().toArrow()
        df = np.zeros(len(vocabulary), np.int64)
        df[holders["term"].to_numpy()] = holders["count"].to_numpy()
        weights = [math.floor(1000 * math.log((2 * count + 2) / (2 * d + 1))) for d in df.tolist()]
        block = Block(listed["no"].to_numpy(), each, np.array(weights, np.int64))
        found.append(ws.stage(rank_block(rows, block, count, length, k), "found"))
    if not found:
        found = [docs.sparkSession.range(0).selectExpr("id AS no", "id AS doc_id", "id AS score")]
    candidates = found[0]
    for more in found[1:]:
        candidates = candidates.unionByName(more)
    order = Window.partitionBy("no").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    ranked = candidates.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.join(queries.select("no", "item_id"), "no").select("item_id", "rank", "doc_id", "score")
