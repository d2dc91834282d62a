"""From chunks that differ to keys that differ."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from replicheck.operators.checksum import Nodes, per_replica
from replicheck.operators.keys import with_rank
from replicheck.sources.store import Workspace
from replicheck.spec import MISSING, PENDING, UNLIKE


def chunk_compare(chunks: DataFrame, replicas: int) -> DataFrame:
    """Each chunk with the word on whether it differs: a replica has no result, or the
    results are not all the same."""
    return chunks.groupBy("table_name", "chunk").agg(
        F.min("upper_boundary").alias("upper_boundary"),
        F.max("lower_boundary").alias("lower_boundary"),
        (
            (F.count("*") < replicas)
            | (F.min("cnt") != F.max("cnt"))
            | (F.min("crc") != F.max("crc"))
        ).alias("differs"),
    )


def chunk_differ(chunks: DataFrame, replicas: int) -> DataFrame:
    return chunk_compare(chunks, replicas).filter("differs").drop("differs")


def drill_keys(chunked: DataFrame, differing: DataFrame) -> DataFrame:
    """Every key of each differing chunk, with what stands beside it."""
    return chunked.join(differing.select("chunk"), "chunk", "left_semi")


def key_checksum(drilled: DataFrame, pk: str, nodes: Nodes) -> DataFrame:
    """Row count and checksum of each drilled key on each replica."""
    return per_replica(drilled, nodes, ["chunk", pk])


def _first(places: list[Column]) -> Column:
    return F.least(*places) if len(places) > 1 else places[0]


def differ_type(nodes: Nodes) -> Column:
    """Kind of the first anomaly in replica order, NULL where there is none.

    A replica without the row is one kind, a row unlike the first replica's the other.
    """
    ords = [ord for ord, _ in nodes]
    cnt, crc = (lambda o: F.col(f"cnt_{o}")), (lambda o: F.col(f"crc_{o}"))
    missing = _first([F.when(cnt(o) == 0, F.lit(o)) for o in ords])
    first = ords[0]
    unlike = _first(
        [
            F.when((cnt(o) > 0) & ((cnt(o) != cnt(first)) | (crc(o) != crc(first))), F.lit(o))
            for o in ords
        ]
    )
    return F.when(
        missing.isNotNull() & (unlike.isNull() | (missing < unlike)), F.lit(MISSING)
    ).when(unlike.isNotNull(), F.lit(UNLIKE))


def key_differ(
    drilled: DataFrame, pk: str, nodes: Nodes, keep: Sequence[Column] = ()
) -> DataFrame:
    """Keys with an anomaly: ``(chunk, pk, differ_type)`` and what else is to be kept.

    The test reads only a key's own row, so Spark applies it below the join of ``drill_keys``
    and only differing keys are joined.
    """
    kind = differ_type(nodes).alias("differ_type")
    return drilled.select("chunk", pk, kind, *keep).filter(F.col("differ_type").isNotNull())


def numbered_differ(
    differing: DataFrame,
    pk: str,
    table: str,
    ws: Workspace,
    after: int = 0,
    partitions: int = 0,
    keep: Sequence[str] = (),
) -> DataFrame:
    """Differing keys as pending entries, numbered on from ``after`` in chunk and key order."""
    ranked = with_rank(differing, ["chunk", pk], ws, partitions, "differ")
    return ranked.select(
        (F.col("rn") + after).alias("id"),
        F.lit(table).alias("table_name"),
        F.col(pk).alias("pk"),
        F.lit(PENDING).cast("int").alias("status"),
        F.col("differ_type").cast("int").alias("differ_type"),
        *keep,
    )


def check_summary(compared: DataFrame, differing: DataFrame) -> DataFrame:
    """Counts of chunks, differing chunks, and differing keys by type, in one row."""
    chunks = compared.agg(
        F.count("*").alias("chunks"), F.count_if("differs").alias("differing_chunks")
    )
    keys = differing.agg(
        F.count("*").alias("differing_keys"),
        F.count_if(F.col("differ_type") == MISSING).alias("missing"),
        F.count_if(F.col("differ_type") == UNLIKE).alias("unlike"),
    )
    names = ["chunks", "differing_chunks", "differing_keys", "missing", "unlike"]
    both = reduce(
        lambda a, b: a.unionByName(b, allowMissingColumns=True), [chunks, keys]
    )
    return both.agg(*[F.max(n).alias(n) for n in names])
