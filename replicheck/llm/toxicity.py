"""Toxicity by non-negative positive-unlabelled learning.

Only confirmed toxic documents count as labelled. The risk over all text splits by the share
``prior`` of toxic documents: ``prior * R+(toxic as 1) + max(0, R-(all as 0) - prior *
R-(toxic as 0))``, where the last bracket is the risk on clean text that the unlabelled sample
implies; where it falls below zero, the step undoes that part instead of following it. The
classifier is logistic and linear over the distinct words of a text and over the beginnings of
words, hashed to ``DIMENSIONS`` weights, with a proximal L1 step that leaves most of them zero.

Fitting takes a bounded sample: at most ``POSITIVES`` toxic and ``UNLABELLED`` other training
documents, the first by a seeded hash of their id. Scoring covers every whole text.

Null and empty texts have no words and get the score of the bias. Several labels of a document
count as toxic if one does. Rows with a null doc_id are scored, never learned from, and not held
out. Repeated rows get equal scores. Without toxic training documents the score is 0 for all.
Extra columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from replicheck.llm.text import give_back, held_out, map_batches, mix, record, seeded

DIMENSIONS = 1 << 20
#: The sample that a fit takes at most.
POSITIVES, UNLABELLED = 4_000, 8_000
SEED = 11
#: Beginnings of words that are features of their own, in characters.
BEGINNINGS = (4, 5, 6)
#: A feature counts if toxic text has it this many times as often as all text.
RATIO = 2.5
#: and if so many would come by chance with a probability of at most exp(-SURPRISE).
SURPRISE = 12.0
CACHE_WORDS = 200_000


def features(word: str) -> list[int]:
    """Hashed features of a lower-cased word."""
    parts = [word] + [f"^{word[:k]}" for k in BEGINNINGS if len(word) > k]
    return [xxh64_intdigest(p) % DIMENSIONS for p in parts]


class WordFeatures(dict):
    def __missing__(self, word: str) -> list[int]:
        if len(self) >= CACHE_WORDS:
            self.clear()
        value = self[word] = features(word)
        return value


def terms(text: str | None) -> set[str]:
    """Distinct lower-cased words without the punctuation around them."""
    if not text:
        return set()
    return {w.strip(".,;:!?\"'()[]") for w in set(text.lower().split())} - {""}


@dataclass(frozen=True)
class Model:
    """Weights by feature, zero where not named, and a bias. One that is not fitted scores 0."""

    index: np.ndarray
    weight: np.ndarray
    bias: float
    fitted: bool = True


def _sample(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``(doc_id, toxic, text)`` of the documents a fit may take, all rows of each id."""
    toxic = labels.groupBy("doc_id").agg(F.max("toxic").alias("toxic")).filter("toxic = 1")
    ids = docs.select("doc_id").filter("doc_id is not null").filter(~held_out()).distinct()
    marked = ids.join(toxic, "doc_id", "left").withColumn("place", seeded("doc_id", SEED))
    chosen = marked.filter("toxic = 1").orderBy("place", "doc_id").limit(POSITIVES).union(
        marked.filter("toxic is null").orderBy("place", "doc_id").limit(UNLABELLED)
    )
    return docs.join(F.broadcast(chosen.select("doc_id", "toxic")), "doc_id").select("doc_id", "toxic", "text")


def _prior(docs: DataFrame, labels: DataFrame) -> float:
    """Share of toxic documents among the labelled ones that are not held out."""
    own = labels.groupBy("doc_id").agg(F.max("toxic").alias("toxic")).filter(~held_out())
    share = own.agg(F.avg((F.col("toxic") == 1).cast("double"))).first()[0]
    return min(max(share or 0.0, 1e-4), 0.5)


def fit_arrays(
    rows: list[np.ndarray],
    positive: np.ndarray,
    prior: float,
    steps: int = 400,
    rate: float = 0.05,
    l1: float = 2e-4,
    l2: float = 1e-4,
) -> Model:
    """Fit on hashed features of each sampled document (distinct in each row)."""
    n_pos, n_all = max(1, positive.sum()), max(1, (~positive).sum())
    seen, around = np.zeros(DIMENSIONS), np.zeros(DIMENSIONS)
    for row, confirmed in zip(rows, positive):
        (seen if confirmed else around)[row] += 1
    # what is about as common in all text as in toxic text is no evidence
    usual = n_pos * (around + 0.5) / n_all
    surprise = seen * np.log(np.maximum(seen, 1) / usual) - (seen - usual)
    keep = np.flatnonzero((seen >= RATIO * usual) & (surprise >= SURPRISE))
    number = np.full(DIMENSIONS, -1)
    number[keep] = np.arange(len(keep))
    rows = [number[r][number[r] >= 0] for r in rows]
    flat = np.concatenate([*rows, np.empty(0, np.int64)])
    of = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    w, mean, square = np.zeros(len(keep)), np.zeros(len(keep)), np.zeros(len(keep))
    bias = float(np.log(prior / (1 - prior)))
    for step in range(1, steps + 1):
        logit = bias + np.bincount(of, w[flat], minlength=len(rows))
        p = 1 / (1 + np.exp(-np.clip(logit, -30, 30)))
        as_clean = -np.log(np.maximum(1 - p, 1e-12))
        clean_risk = as_clean[~positive].mean() - prior * as_clean[positive].mean()
        # by logit, the loss of a 1 has the slope p - 1 and that of a 0 the slope p
        confirmed = np.where(positive, prior * (p - 1) / n_pos, 0.0)
        negative = np.where(positive, -prior * p / n_pos, p / n_all)
        slope = confirmed + negative if clean_risk >= 0 else -negative
        g = np.bincount(flat, slope[of], minlength=len(keep)) + l2 * w
        mean, square = 0.9 * mean + 0.1 * g, 0.99 * square + 0.01 * g * g
        size = rate / (np.sqrt(square / (1 - 0.99**step)) + 1e-6)
        w = w - size * mean / (1 - 0.9**step)
        w = np.sign(w) * np.maximum(np.abs(w) - size * l1, 0)
        bias -= rate * float(slope.sum())
    left = np.flatnonzero(w)
    return Model(keep[left], w[left], bias)


def without_copies(rows: list[np.ndarray], order: list[int], bands: int = 8) -> list[int]:
    """``order`` without near copies of what stands before: words of a text that was copied often
    would look like evidence. Rows are compared that share the two smallest hashes of
    one of ``bands`` permutations."""
    first: dict[tuple, int] = {}
    kept = []
    for i in order:
        keys = []
        for b in range(bands if len(rows[i]) > 1 else 0):
            h = mix(rows[i].astype(np.uint64) + np.uint64((b + 1) << 32))
            keys.append((b, *np.partition(h, 1)[:2].tolist()))
        like = {first[k] for k in keys if k in first}
        both = max((len(np.intersect1d(rows[i], rows[j], True)) / len(np.union1d(rows[i], rows[j])) for j in like), default=0)
        if both < 0.4:
            kept.append(i)
            for k in keys:
                first.setdefault(k, i)
    return kept


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    """Fit on the bounded sample; labels of held-out documents are not read."""
    labels = labels.select(F.col("doc_id").cast("long").alias("doc_id"), "toxic").filter("toxic is not null")
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")

    def make():
        known = WordFeatures()

        def step(batch: pa.RecordBatch):
            out = [
                np.unique(np.array([f for t in terms(x) for f in known[t]], np.int32)).tobytes()
                for x in batch.column("text").to_pylist()
            ]
            ids, toxic = batch.column("doc_id"), batch.column("toxic")
            return record(doc_id=ids, toxic=toxic, grams=pa.array(out, pa.binary()))

        return step

    sample = _sample(docs, labels.filter(~held_out())).withColumn("toxic", F.col("toxic").cast("int"))
    features = map_batches(sample, "doc_id long, toxic int, grams binary", make)
    # of rows that share an id one counts, so that the sample is as large as its ids are many
    rows = features.groupBy("doc_id", "toxic").agg(F.min("grams").alias("grams")).toArrow()
    positive = np.array([t == 1 for t in rows.column("toxic").to_pylist()], bool)
    if not positive.any() or positive.all():
        return Model(np.empty(0, np.int64), np.empty(0), 0.0, fitted=False)
    grams = [np.frombuffer(b, np.int32) for b in rows.column("grams").to_pylist()]
    order = without_copies(grams, sorted(range(len(grams)), key=lambda i: (not positive[i], grams[i].tobytes())))
    model = fit_arrays([grams[i] for i in order], positive[order], _prior(docs, labels))
    del grams, rows
    give_back()
    return model


def score(docs: DataFrame, model: Model, text: str = "text", column: str = "score") -> DataFrame:
    """All columns and ``column``: the estimated chance that the whole text is toxic."""
    shared = docs.sparkSession.sparkContext.broadcast((model.index, model.weight, model.bias, model.fitted))
    fields = docs.schema.fields
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields) + f", `{column}` double"

    def make():
        index, weight, bias, fitted = shared.value
        weights = dict(zip(index.tolist(), weight.tolist()))

        class Known(dict):
            def __missing__(self, word: str) -> tuple:
                if len(self) >= CACHE_WORDS:
                    self.clear()
                value = self[word] = tuple((f, weights[f]) for f in features(word) if f in weights)
                return value

        known = Known()

        def one(text: str | None) -> float:
            if not fitted:
                return 0.0
            found = dict(e for t in terms(text) if (v := known[t]) for e in v)
            logit = bias + sum(found[k] for k in sorted(found))
            return float(1 / (1 + np.exp(-min(max(logit, -500.0), 500.0))))

        def step(batch: pa.RecordBatch):
            out = [one(t) for t in batch.column(text).to_pylist()]
            return pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(out, pa.float64())], names=[*batch.schema.names, column]
            )

        return step

    return map_batches(docs, schema, make)


def judge(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for every document."""
    model = fit(docs, labels)
    return score(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), model).select(
        "doc_id",
        F.coalesce(held_out(), F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )
