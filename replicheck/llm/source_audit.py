"""How far the sources of a language differ in their words.

Counting works on the bytes of Arrow buffers. A shard's words are pointers to their starts. The
pointers are sorted like a multikey quicksort does, with eight bytes as one key: a slice is
quicksorted by one key, and its runs of equal keys are the slices of the next one, until a key
ends the word. Runs of equal words then give, for each source, occurrences and documents. Spark
adds the shards up by language, source and word, keeps the words of enough documents, and
compares shares: whole-number parts of a thousand million, smoothed, as ``share`` has them.

Every pair of sources is summed without a join of pairs: a task holds the shares of one word in
all sources of the language beside each other and adds their distances to a square of sums, a
strip of ``TILE`` sources at a time.

Nulls in text, language or source are read as empty. Repeated rows count as documents of their
own, whatever their ids; extra columns are not read. A language that keeps no word has pairs of
value 0 and no terms; an empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from replicheck.llm.bpe import ragged
from replicheck.llm.text import give_back
from replicheck.sources import Workspace

#: Documents of a language that a kept word occurs in, and ranks of the words reported.
DOCUMENTS, TERMS = 30, 50
#: Parts that a share counts, as a power of a thousand, and what is added to each count.
THOUSANDS, SMOOTHING = 3, 5
#: Bytes of text sorted at once, and rows of a batch that are taken together.
SHARD_BYTES, SLICE_ROWS = 12_000_000, 500
#: Sources of a strip, and counts of a block, in the comparison of pairs.
TILE, BLOCK = 512, 2_000_000

#: Bytes of words as they are compared, 0 for all others. Bytes from 128 on belong to letters
#: and signs beyond ASCII, all of which count as parts of words.
WORD_BYTES = np.zeros(256, np.uint8)
WORD_BYTES[128:] = np.arange(128, 256)
WORD_BYTES[65:91] = WORD_BYTES[97:123] = np.arange(97, 123)
#: Which bytes of a key belong to a word with so many bytes left.
KEEP = np.array([(1 << 64) - (1 << 8 * (8 - k)) for k in range(9)], np.uint64)


def word_pointers(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and lengths of all words of texts that lie behind each other."""
    inside = data != 0
    before, behind = np.zeros(len(data) + 1, bool), np.zeros(len(data) + 1, bool)
    before[1:] = inside
    before[offsets] = False
    behind[:-1] = inside
    behind[offsets] = False
    starts = np.flatnonzero(inside & ~before[:-1])
    ends = np.flatnonzero(inside & ~behind[1:]) + 1
    return starts, ends - starts


def sort_pointers(
    data: np.ndarray, starts: np.ndarray, lengths: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """The order of the words, and for each place in it whether another word begins there.
    ``data`` has eight more bytes behind its last word."""
    keys = np.ndarray(max(len(data) - 7, 0), ">u8", data.data, strides=(1,))

    def key(which: np.ndarray, depth: int) -> np.ndarray:
        left = np.clip(lengths[which] - depth, 0, 8)
        at = np.minimum(starts[which] + depth, max(len(keys) - 1, 0))
        return keys[at].astype(np.uint64) & KEEP[left]

    n = len(starts)
    first = key(np.arange(n), 0)
    order = np.argsort(first)
    new = np.ones(n, bool)
    new[1:] = first[order[1:]] != first[order[:-1]]
    slices, depth = np.cumsum(new), 8
    places = np.flatnonzero(_open(new, lengths[order] > depth))
    slices = slices[places]
    while len(places):  # places of slices that are not sorted to their end
        which = order[places]
        value = key(which, depth)
        by = np.lexsort((value, slices))
        order[places], value, slices = which[by], value[by], slices[by]
        cut = np.ones(len(places), bool)
        cut[1:] = (value[1:] != value[:-1]) | (slices[1:] != slices[:-1])
        new[places[cut]] = True
        depth += 8
        still = _open(cut, lengths[order[places]] > depth)
        places, slices = places[still], np.cumsum(cut)[still]
    return order, new


def _open(new: np.ndarray, longer: np.ndarray) -> np.ndarray:
    """Places of runs of two or more of which any word goes on."""
    if not len(new):
        return new
    at = np.flatnonzero(new)
    sizes = np.diff(at, append=len(new))
    return np.repeat(np.logical_or.reduceat(longer, at) & (sizes > 1), sizes)


def count_shard(texts: pa.StringArray, groups: np.ndarray) -> tuple[pa.Array, ...]:
    """``(word, group, occurrences, documents)`` of every word and group of documents."""
    _, ends, buffer = texts.buffers()
    offsets = np.frombuffer(ends, np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    raw = np.frombuffer(buffer, np.uint8) if buffer is not None else np.zeros(0, np.uint8)
    data = np.zeros(int(offsets[-1] - offsets[0]) + 8, np.uint8)
    data[:-8] = WORD_BYTES[raw[offsets[0] : offsets[-1]]]
    offsets = offsets - offsets[0]
    starts, lengths = word_pointers(data[:-8], offsets)
    order, new = sort_pointers(data, starts, lengths)
    by_group = np.argsort(groups, kind="stable")
    place = np.empty(len(groups), np.int64)
    place[by_group] = np.arange(len(groups))
    document = place[np.searchsorted(offsets, starts[order], "right") - 1]
    total = max(len(groups), 1)
    seen = np.sort((np.cumsum(new) - 1) * total + document)
    word, document = np.divmod(seen, total)
    group = groups[by_group][document]
    cut = np.ones(len(seen), bool)
    cut[1:] = (word[1:] != word[:-1]) | (group[1:] != group[:-1])
    at = np.flatnonzero(cut)
    other = np.ones(len(seen), bool)
    other[1:] = seen[1:] != seen[:-1]
    documents = np.add.reduceat(other, at, dtype=np.int64) if len(at) else at
    head = order[new]
    sizes = lengths[head]
    values = ragged(data, starts[head], sizes)
    bounds = np.concatenate(([0], np.cumsum(sizes))).astype(np.int32)
    words = pa.StringArray.from_buffers(len(head), pa.py_buffer(bounds), pa.py_buffer(values))
    return words.take(pa.array(word[at])), group[at], np.diff(at, append=len(seen)), documents


def word_counts(docs: DataFrame) -> DataFrame:
    """``(lang, source, term, cnt, df)``: occurrences and documents, summed over all documents."""
    named = [F.coalesce(c, F.lit("")).alias(c) for c in ("lang", "source", "text")]

    def counted(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
        rows = pa.Table.from_batches(parts).combine_chunks()
        number: dict = {}
        pairs = zip(rows["lang"].to_pylist(), rows["source"].to_pylist())
        groups = np.array([number.setdefault(p, len(number)) for p in pairs], np.int64)
        terms, group, cnt, df = count_shard(rows["text"].chunk(0), groups)
        which = pa.array(group)
        langs, sources = (pa.array([p[k] for p in number], pa.string()).take(which) for k in (0, 1))
        return pa.RecordBatch.from_arrays(
            [langs, sources, terms, pa.array(cnt), pa.array(df)], names=["lang", "source", "term", "cnt", "df"]
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, size = [], 0
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE_ROWS):
                part = batch.slice(at, SLICE_ROWS)
                parts.append(part)
                size += pc.sum(pc.binary_length(part.column("text"))).as_py() or 0
                if size >= SHARD_BYTES:
                    yield counted(parts)
                    parts, size = [], 0
        if parts:
            yield counted(parts)
        give_back()

    shards = docs.select(*named).mapInArrow(run, "lang string, source string, term string, cnt bigint, df bigint")
    return shards.groupBy("lang", "source", "term").agg(F.sum("cnt").alias("cnt"), F.sum("df").alias("df"))


def _digits(part, whole, divide):
    """The whole part of ``1000 ** THOUSANDS * part / whole`` by long division, three digits at
    a time, so that no product leaves 64 bits while ``whole`` stays below 9e15."""
    quotient = 0
    for _ in range(THOUSANDS):
        part = part * 1000
        quotient = quotient * 1000 + divide(part, whole)
        part = part % whole
    return quotient


def share(cnt: Column, total: Column, kept: Column) -> Column:
    """A word's smoothed share of all occurrences of kept words."""
    return F.lit(1) + _digits(cnt + SMOOTHING, total + SMOOTHING * kept, partial(F.call_function, "div"))


def pair_sums(kept: DataFrame, langs: DataFrame) -> DataFrame:
    """``(lang, a, b, value)``: the summed distance of the shares of sources a and b."""
    rows = kept.join(langs.filter("size(totals) > 1"), "lang").select(
        "lang",
        F.explode(F.sequence(F.lit(0), F.call_function("div", F.size("totals") - 1, F.lit(TILE)).cast("int"))).alias("tile"),
        "kept",
        "totals",
        F.col("entries.no").alias("no"),
        F.col("entries.cnt").alias("cnt"),
    )

    def lists(column: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
        return column.offsets.to_numpy(), column.values.to_numpy(zero_copy_only=False)

    def add(batch: pa.RecordBatch, sums: np.ndarray, tile: int) -> None:
        at, totals = lists(batch.column("totals"))
        whole = totals[at[0] : at[1]] + SMOOTHING * batch.column("kept")[0].as_py()
        at, numbers = lists(batch.column("no"))
        _, counts = lists(batch.column("cnt"))
        rows = np.repeat(np.arange(batch.num_rows), np.diff(at))
        table = np.full((batch.num_rows, len(whole)), SMOOTHING, np.int64)
        table[rows, numbers[at[0] : at[-1]]] += counts[at[0] : at[-1]]
        shares = _digits(table, whole, np.floor_divide)  # one added to both is no distance
        for k in range(len(sums)):
            sums[k] += np.abs(shares - shares[:, [tile * TILE + k]]).sum(0)

    def out(lang: str, tile: int, sums: np.ndarray) -> pa.RecordBatch:
        a, b = np.indices(sums.shape).reshape(2, -1)
        columns = {"lang": [lang] * sums.size, "a": a + tile * TILE, "b": b, "value": sums.ravel()}
        return pa.RecordBatch.from_pydict(columns, pa.schema([("lang", pa.string()), *[(c, pa.int64()) for c in "ab"], ("value", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, sums = None, None
        for batch in batches:
            keys = list(zip(batch.column("lang").to_pylist(), batch.column("tile").to_pylist()))
            cuts = [0, *[k for k in range(1, len(keys)) if keys[k] != keys[k - 1]], len(keys)]
            for low, high in zip(cuts, cuts[1:]):
                sources = len(batch.column("totals")[low])
                if held != keys[low]:
                    if held is not None:
                        yield out(*held, sums)
                    held = keys[low]
                    sums = np.zeros((min(TILE, sources - held[1] * TILE), sources), np.int64)
                step = max(1, BLOCK // sources)
                for at in range(low, high, step):
                    add(batch.slice(at, min(step, high - at)), sums, held[1])
        if held is not None:
            yield out(*held, sums)
        give_back()

    strips = rows.sortWithinPartitions("lang", "tile").mapInArrow(run, "lang string, a bigint, b bigint, value bigint")
    return strips.groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))


def audit(docs: DataFrame, documents: int = DOCUMENTS, terms: int = TERMS) -> DataFrame:
    """``(lang, source, part, item, value, rank)``: for each source of a language, part ``pair``
    has every other source with the summed distance of their shares, part ``term`` the words
    whose share most exceeds the language's, to rank ``terms``. Kept words occur in at least
    ``documents`` documents of the language."""
    ws = Workspace(docs.sparkSession)
    occurring = docs.select(*[F.coalesce(c, F.lit("")).alias(c) for c in ("lang", "source")]).distinct()
    numbering = F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1
    groups = ws.stage(occurring.withColumn("no", numbering.cast("bigint")), "groups")
    kept = ws.stage(
        word_counts(docs)
        .join(groups, ["lang", "source"])
        .groupBy("lang", "term")
        .agg(
            F.sum("df").alias("df"),
            F.sum("cnt").alias("total"),
            F.collect_list(F.struct("no", "cnt")).alias("entries"),
        )
        .filter(F.col("df") >= documents),
        "kept",
    )
    each = kept.select("lang", "term", "total", F.inline("entries"))
    totals = groups.join(each.groupBy("lang", "no").agg(F.sum("cnt").alias("n")), ["lang", "no"], "left")
    totals = ws.stage(totals.withColumn("n", F.coalesce("n", F.lit(0))), "totals")
    in_order = F.array_sort(F.collect_list(F.struct("no", "n")))
    langs = ws.stage(
        totals.groupBy("lang")
        .agg(in_order.getField("n").alias("totals"), F.sum("n").alias("whole"))
        .join(kept.groupBy("lang").agg(F.count("*").alias("kept")), "lang"),
        "langs",
    )
    shares = (
        each.join(totals, ["lang", "no"])
        .join(langs.drop("totals"), "lang")
        .withColumn("q", share(F.col("total"), F.col("whole"), F.col("kept")))
        .withColumn("value", share(F.col("cnt"), F.col("n"), F.col("kept")) - F.col("q"))
        .filter("value > 0")
        .select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), "value")
    )
    by_value = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    rank = F.row_number().over(by_value).alias("rank")
    best = shares.select("*", rank).filter(F.col("rank") <= terms)
    mine = groups.select("lang", "source", F.col("no").alias("a"))
    theirs = groups.select("lang", F.col("source").alias("item"), F.col("no").alias("b"))
    pairs = (
        mine.join(theirs, "lang")
        .filter("a <> b")
        .join(pair_sums(kept, langs), ["lang", "a", "b"], "left")
        .select("lang", "source", F.lit("pair").alias("part"), "item", F.coalesce("value", F.lit(0)).alias("value"))
    )
    return pairs.select("*", rank).unionByName(best)
