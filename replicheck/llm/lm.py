"""Stupid-backoff scores of documents under a bigram model of the whole corpus.

A text's words (A-Z lower-cased) are known by their full 64-bit hashes; 0 starts each text. Word
counts are a table spread by the word's hash and pair counts one spread by a word of the pair, so
both grow with the corpus; neither is broadcast. Every document is exploded to its distinct pairs
with their number. All tasks have the counts of the ``KNOWN`` most frequent words. These rows are
shuffled once, by the pair's first word, or by the second one where that is not known. They get the
pair's count in the corpus as a sum over all its rows and that word's count by a join with the table
of words, so either word's count is there unless neither is known; they are then summed by document.
Only of pairs of two unknown words that other documents share, rows go to the first word for its count.

Words that hold over 1 / ``HEAVY`` of all words are heavy; there are at most ``HEAVY`` of them (and
the start), and their counts go to all tasks. A pair that only begins with a heavy word lies with
its second word. Pairs of two heavy words may be hot: their rows are dealt to ``SALTS`` places, then
counted from one row a text, and that table of at most ``(HEAVY + 1) ** 2`` rows is broadcast.

A word w after v scores ``c(v w) / c(v)`` with a document's own occurrences of the pair taken out
of ``c(v w)``; where nothing is left it backs off to ``ALPHA * c(w) / N``, with N words in all.
A document's score is the mean of the natural logarithms over its words.

Null and empty texts have no words and a null score. Every row is a document of its own, also
where rows share a doc_id, lack one or are equal: rows are numbered as they are exploded, and the
row of their number carries the doc_id along, so one reading of the texts tells them apart.
Extra columns are not read.
"""

from __future__ import annotations

from itertools import count, islice

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from replicheck.llm.text import WordHash, lower_words, map_batches, record
from replicheck.sources import Workspace

ALPHA = 0.4
HEAVY = 300
KNOWN = 65_536
SALTS = 255
#: No word's hash lies within so much of 0: places and codes of heavy words do.
RESERVED = 1 << 20
#: Texts whose pairs are sorted together.
PAIRED = 1_000
CODES = 1 << 9
#: From here on, places in the known words tell the second word of a pair, then the first one.
SECOND = CODES**2
FIRST = SECOND + KNOWN


NO_WORDS = np.empty(0, np.int64)


def classes(hashes: np.ndarray) -> np.ndarray:
    """0 for the start, then each word's hash as a signed number out of the reserved range."""
    h = hashes.view(np.int64)
    return np.concatenate(([0], np.where(np.abs(h) < RESERVED, h ^ (1 << 40), h)))


def _word_counts(docs: DataFrame) -> DataFrame:
    """``(word, count)`` by slice of rows."""

    def make():
        hashes = WordHash()

        def step(batch: pa.RecordBatch):
            found = [classes(hashes.of(w)) for t in batch.column("text").to_pylist() if (w := lower_words(t))]
            if not found:
                return None
            word, times = np.unique(np.concatenate(found), return_counts=True)
            return record(word=word, count=times)

        return step

    return map_batches(docs.select("text"), "word long, count long", make, 10_000)


def _codes(words: np.ndarray, heavy: np.ndarray) -> np.ndarray:
    """Each word's place in the sorted ``heavy``, from 1; 0 for other words."""
    if not len(heavy):
        return np.zeros(len(words), np.int64)
    at = np.minimum(np.searchsorted(heavy, words), len(heavy) - 1)
    return np.where(heavy[at] == words, at + 1, 0)


def _pairs(docs: DataFrame, heavy: np.ndarray, known: np.ndarray) -> DataFrame:
    """``(own, a, b, row, doc_id)``: distinct pairs of a text, with ``a`` for their place. They are
    ``w`` and the code of ``v`` where that alone is ``heavy``, or a negative salt and the codes of
    both, or ``v`` and the place of a ``known`` ``w``, or ``w`` and the place of a known ``v``, or ``w`` and
    ``v``. Rows of a slice are sorted, so that equal numbers
    compress, and the numbers that differ most stand side by side. Each text has one more row, of
    0 occurrences, that has its doc_id."""

    def make():
        hashes = WordHash()
        numbers = count(TaskContext.get().partitionId() << 33)

        def step(batch: pa.RecordBatch):
            row = np.fromiter(islice(numbers, batch.num_rows), np.int64, batch.num_rows)
            salts = -1 - row % SALTS
            found = [
                classes(hashes.of(w)) if (w := lower_words(t)) else NO_WORDS
                for t in batch.column("text").to_pylist()
            ]
            text_of = np.repeat(np.arange(len(found), dtype=np.int32), [len(c) for c in found])
            word = np.concatenate(found)
            code = _codes(word, heavy)
            first = np.flatnonzero(text_of[:-1] == text_of[1:])
            v, w, vc, wc, text_of = word[first], word[first + 1], code[first], code[first + 1], text_of[first]
            salt = salts[text_of]
            place = _codes(word, known)
            vp, wp = place[first], place[first + 1]
            b = np.where(wp > 0, SECOND + wp, np.where(vp > 0, FIRST + vp, v))
            b = np.where(vc == 0, b, np.where(wc == 0, vc, vc * CODES + wc))
            a = np.where(vc == 0, np.where(wp > 0, v, w), np.where(wc == 0, w, salt))
            order = np.lexsort((b, a))  # stable: rows of a pair stay in the order of texts
            a, b, text_of = a[order], b[order], text_of[order]
            other = np.ones(len(a), bool)
            other[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1]) | (text_of[1:] != text_of[:-1])
            starts = np.flatnonzero(other)
            own = np.diff(np.append(starts, len(a))).astype(np.int32)
            pairs, texts = len(starts), len(row)
            return record(
                own=np.concatenate((own, np.zeros(texts, np.int32))),
                a=np.concatenate((a[starts], salts)),
                b=pa.concat_arrays([pa.array(b[starts]), pa.nulls(texts, pa.int64())]),
                row=np.concatenate((row[text_of[starts]], row)),
                doc_id=pa.concat_arrays([pa.nulls(pairs, pa.int64()), batch.column("doc_id").cast(pa.int64())]),
            )

        return step

    return map_batches(docs.select("doc_id", "text"), "own int, a long, b long, row long, doc_id long", make, PAIRED)


def _known(spark: SparkSession, counts: list[int], times: np.ndarray) -> DataFrame:
    """``(b, c_v, c_w)``: what ``b`` tells of a row's words: the ``counts`` of heavy ones and the
    ``times`` of known ones as either word; one row for each of ``HEAVY`` and two for each of ``KNOWN``."""
    place = np.arange(1, len(times) + 1)
    first = pa.table({"b": np.concatenate((np.arange(1, len(counts) + 1), FIRST + place)),
                      "c_v": np.concatenate((np.array(counts, np.int64), times))})
    second = pa.table({"b": SECOND + place, "c_w": times})
    return spark.createDataFrame(pa.concat_tables([first, second], promote_options="default"), "b long, c_v long, c_w long")


def scores(docs: DataFrame, ws: Workspace | None = None) -> DataFrame:
    """``doc_id, n_words, n_backed_off, score`` for every document."""
    ws = ws or Workspace(docs.sparkSession)
    single = ws.stage(_word_counts(docs).groupBy("word").agg(F.sum("count").alias("count")), "words")
    total = single.filter("word <> 0").agg(F.coalesce(F.sum("count"), F.lit(0))).first()[0]
    found = single.filter(F.col("count") * HEAVY > total).orderBy("word").collect()  # at most HEAVY and the start
    heavy, counts = np.array([r["word"] for r in found], np.int64), [r["count"] for r in found]
    most = single.filter("word <> 0").orderBy(F.desc("count"), "word").limit(KNOWN)
    most = most.toArrow().sort_by("word")  # at most KNOWN
    known = F.broadcast(_known(docs.sparkSession, counts, most["count"].to_numpy()))
    # a hash join, so that the many rows are not sorted once more
    at_a = single.select(F.col("word").alias("a"), F.col("count").alias("c_a")).hint("shuffle_hash")
    # a window and not a join with the sums: rows are shuffled once
    counted = (
        _pairs(docs, heavy, most["word"].to_numpy())
        .repartition("a")
        .withColumn("c_here", F.sum("own").over(Window.partitionBy("a", "b")))
        .select("row", "doc_id", "a", "b", "own", "c_here")
    )
    n = max(total, 1)
    backs_off = lambda count: F.log(F.lit(ALPHA) * count / F.lit(n))
    hot = lambda b: b.between(CODES, SECOND)
    # a row lies with one of its words, and the known table has the other, unless neither is known
    others = F.col("c_here") - F.col("own")
    c_v = F.coalesce("c_v", F.when(F.col("c_w").isNotNull(), F.col("c_a")))
    left = hot(F.col("b")) | (others > 0) & c_v.isNull()
    sums = (
        counted.join(at_a, "a", "left")
        .join(known, "b", "left")
        .select(
            "row", "doc_id", "own", F.when(others > 0, 0).otherwise(F.col("own")).alias("backed"),
            F.when(left, F.col("b")).alias("left"),
            F.when(others > 0, F.log(others / F.coalesce(c_v, F.lit(1)))).otherwise(backs_off(F.coalesce("c_w", "c_a")))
            .alias("log"),
        )
        .groupBy("row", "left")
        .agg(
            F.max("doc_id").alias("doc_id"),
            F.sum("own").alias("n_words"),
            F.sum("backed").alias("n_backed_off"),
            F.sum(F.col("own") * F.col("log")).alias("sum"),
        )
    )
    sums = ws.stage(sums, "sums")
    parts = ["row", "doc_id", "n_words", "n_backed_off", "sum"]
    # pairs of two unknown words that other texts share lack the first word's count
    unknown = sums.filter(F.col("left").isNotNull() & ~hot(F.col("left"))).join(single, F.col("left") == F.col("word"))
    unknown = unknown.withColumn("sum", F.col("sum") - F.col("n_words") * F.log("count")).select(*parts)
    # and those of two heavy words, of which each text has one row, their own count
    heavy_rows = sums.filter(hot(F.col("left")))
    c_hot = heavy_rows.groupBy("left").agg(F.sum("n_words").alias("c_hot"))
    of = F.array(*[F.lit(c).cast("long") for c in counts]) if counts else F.array().cast("array<long>")
    count_of = lambda code: F.try_element_at(of, F.expr(code))
    others = F.col("c_hot") - F.col("n_words")
    log = F.when(others > 0, F.log(others / count_of(f"int(left div {CODES})")))
    log = log.otherwise(backs_off(count_of(f"int(left % {CODES})")))
    both = (
        heavy_rows.join(F.broadcast(c_hot), "left")
        .withColumn("n_backed_off", F.when(others > 0, 0).otherwise(F.col("n_words")))
        .withColumn("sum", F.col("n_words") * log)
        .select(*parts)
    )
    scored = (
        sums.filter("left is null")
        .select(*parts)
        .union(unknown)
        .union(both)
        .groupBy("row")
        .agg(
            F.max("doc_id").alias("doc_id"),
            F.sum("n_words").alias("n_words"),
            F.sum("n_backed_off").alias("n_backed_off"),
            F.sum("sum").alias("sum"),
        )
    )
    zero = F.lit(0).cast("long")
    return scored.select(
        "doc_id",
        F.coalesce("n_words", zero).alias("n_words"),
        F.coalesce("n_backed_off", zero).alias("n_backed_off"),
        (F.col("sum") / F.when(F.col("n_words") > 0, F.col("n_words"))).alias("score"),
    )
