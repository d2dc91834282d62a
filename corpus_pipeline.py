"""A training corpus from raw documents: toxic texts out, one text of each group of near copies,
personal data masked, sources mixed to their weights, and texts encoded to tokens.

Each stage takes ``(spark, docs, sf_dir)``, works on all documents that the one before kept, and
returns them; all but the last return the columns of ``documents``. ``run`` writes each stage's
rows as Parquet below the folder of working tables and reads them again.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from replicheck.llm import bpe, jaccard, mixing, pii, toxicity
from replicheck.llm.queries import vocabulary
from replicheck.llm.text import read_table
from replicheck.sources import Workspace

#: Words a shingle and percent of shared shingles from which texts are near copies. The query
#: op3_ngram_jaccard has a contract of its own.
SHINGLE, ALIKE = 5, 80
#: Rows and bytes that go to a Python worker at once. Both sides hold such a batch whole, and rows
#: are texts.
BATCH, BATCH_BYTES = 2_000, 2 << 20
BATCH_LIMITS = {
    "spark.sql.execution.arrow.maxRecordsPerBatch": BATCH,
    "spark.sql.execution.arrow.maxBytesPerBatch": BATCH_BYTES,
}


def limit_batches(spark: SparkSession) -> None:
    """Batches of at most ``BATCH`` rows and about ``BATCH_BYTES`` from here on. Each stage sets
    this for itself and leaves it set: its rows are made later, when its caller writes them."""
    for name, most in BATCH_LIMITS.items():
        now = spark.conf.get(name).removesuffix("b")
        if not now.isdigit() or not 0 < int(now) <= most:
            spark.conf.set(name, str(most))


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose score stays below 0.5."""
    limit_batches(spark)
    model = toxicity.fit(docs, read_table(spark, sf_dir, "labels"))
    scored = toxicity.score(docs, model, column="__toxicity")
    return scored.filter(F.col("__toxicity") < 0.5).drop("__toxicity")


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The row of the smallest id of each linked group, and all that link with nothing. Rows are
    told apart by themselves, so that of copies that share an id, or lack one, one row stays."""
    limit_batches(spark)
    ws = Workspace(spark)
    rows = ws.stage(docs.withColumn("__row", F.monotonically_increasing_id()), "rows")
    groups = jaccard.duplicates(
        rows.select(F.col("__row").alias("doc_id"), "text"), size=SHINGLE, percent=ALIKE
    ).select(F.col("doc_id").alias("__row"), F.col("component_id").alias("group"))
    ids = rows.select("__row", F.struct(F.col("doc_id").isNull(), "doc_id", "__row").alias("place"))
    placed = ws.stage(groups.join(ids, "__row"), "placed")
    first = placed.groupBy("group").agg(F.min("place").alias("first"), F.count("*").alias("n"))
    several = first.filter("n > 1").drop("n")
    # staged, so that its size decides how the texts meet it before they are shuffled
    gone = ws.stage(placed.join(several, "group").filter("place <> first").select("__row"), "gone")
    return rows.join(gone, "__row", "left_anti").drop("__row")


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every span of personal data replaced by its kind; ``n_chars`` counts the new text."""
    limit_batches(spark)
    return pii.redact(docs).withColumn("n_chars", F.length("text").cast("long"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it."""
    limit_batches(spark)
    return mixing.repeated(docs, F.array("source"))


def encode_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id, source, n_tokens, ids``: the tokens of every text."""
    limit_batches(spark)
    encoded = bpe.encode(docs, vocabulary(), public_tokenizers.PATTERN, keep=("doc_id", "source"))
    return encoded.select("doc_id", "source", F.size("ids").cast("long").alias("n_tokens"), "ids")


STAGES = [
    ("toxicity", drop_toxic),
    ("ngram_jaccard", drop_near_copies),
    ("pii", mask_personal_data),
    ("source_mix", mix_sources),
    ("byte_bpe", encode_texts),
]

#: The stages that learn, and the tokens, are beyond SQL; tests compare with plain Python.
ORACLE_SQL = None


@contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """Batches within ``BATCH_LIMITS`` in what is run inside, the session's own after it."""
    before = {name: spark.conf.get(name) for name in BATCH_LIMITS}
    limit_batches(spark)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    ws = Workspace(spark)
    docs = read_table(spark, sf_dir, "documents")
    with small_batches(spark):
        for name, stage in STAGES:
            docs = ws.stage(stage(spark, docs, sf_dir), name)
    return docs
