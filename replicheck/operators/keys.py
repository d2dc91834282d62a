"""The common set of keys, its order, and its cut into chunks."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from replicheck.sources.store import Workspace

_LOCAL_BITS = 33  # monotonically_increasing_id: partition above, row number in it below


def key_universe(rows: DataFrame, pk: str) -> DataFrame:
    """Every key that some replica holds, once."""
    return rows.select(pk).distinct()


def key_min_max(keys: DataFrame, pk: str) -> DataFrame:
    return keys.agg(F.min(pk).alias("min_key"), F.max(pk).alias("max_key"))


def key_count(keys: DataFrame) -> DataFrame:
    return keys.agg(F.count("*").alias("cnt"))


def next_key(ranked: DataFrame, pk: str) -> DataFrame:
    """Each key of a chunk with the key that follows it in the chunk (NULL after the last)."""
    w = Window.partitionBy("chunk").orderBy(pk)
    return ranked.select("chunk", pk, F.lead(pk).over(w).alias("next_key"))


def key_after(keys: DataFrame, pk: str, key) -> DataFrame:
    """The smallest key greater than ``key``; NULL where there is none."""
    return keys.filter(F.col(pk) > F.lit(key)).agg(F.min(pk).alias("next_key"))


def in_order(df: DataFrame, order: Sequence[str], partitions: int = 0) -> DataFrame:
    """Rows shuffled once by range and sorted in their partitions, each with its ``place``.

    Range bounds are sampled, so the result has to be staged before ``numbered`` reads it.
    """
    by_range = (
        df.repartitionByRange(partitions, *order) if partitions else df.repartitionByRange(*order)
    )
    return by_range.sortWithinPartitions(*order).withColumn(
        "place", F.monotonically_increasing_id()
    )


def starts(placed: DataFrame) -> DataFrame:
    """``(part, start, rows)``: how many rows lie before each partition of ``in_order``. One row
    per partition is all that is summed in one place."""
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    counts = placed.groupBy(F.shiftrightunsigned("place", _LOCAL_BITS).alias("part")).agg(
        F.count("*").alias("rows")
    )
    return counts.select("part", F.coalesce(F.sum("rows").over(earlier), F.lit(0)).alias("start"), "rows")


def numbered(placed: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """Staged rows of ``in_order`` numbered 1, 2, … as ``rn``, exactly.

    No task sees all rows: a partition's first number follows from the row counts of those
    before it (``starts``, if they are ``known``), which are broadcast.
    """
    before = (known if known is not None else starts(placed)).select(
        F.col("part").alias("_part"), F.col("start").alias("_start")
    )
    local = F.col("place").bitwiseAND(F.lit((1 << _LOCAL_BITS) - 1))
    return (
        placed.withColumn("_part", F.shiftrightunsigned("place", _LOCAL_BITS))
        .join(F.broadcast(before), "_part")
        .withColumn("rn", F.col("_start") + local + 1)
        .drop("place", "_part", "_start")
    )


def in_span(
    placed: DataFrame, known: DataFrame, bounds: Sequence[tuple[int, int]], first: int, last: int
) -> DataFrame:
    """Rows numbered ``first`` to ``last``. Places of partitions outside reach the scan as
    bounds, so that other files are not read; ``bounds`` are the ``(part, start)`` of ``known``."""
    inside = [part for part, start in bounds if start < last]
    low = max([part for part, start in bounds if start < first], default=0)
    high = max(inside, default=-1)
    near = placed.filter(
        (F.col("place") >= low << _LOCAL_BITS) & (F.col("place") < (high + 1) << _LOCAL_BITS)
    )
    return numbered(near, known).filter(F.col("rn").between(first, last))


@dataclass(frozen=True)
class Segment:
    """Chunks counted on from ``chunk``, ``size`` keys each, from key number ``rn`` on. The
    ``number`` tells apart what was counted by one segment and by another."""

    rn: int
    chunk: int
    size: int
    number: int = 1

    def chunk_of(self, rank: Column) -> Column:
        return chunk_number(rank - (self.rn - 1), self.size, self.chunk)

    def holding(self, rank: int) -> int:
        return self.chunk + (rank - self.rn) // self.size

    def first_key(self, chunk: int) -> int:
        return self.rn + (chunk - self.chunk) * self.size


def segment_after(
    segments: Sequence[Segment], last_chunk: int, size: int, number: int
) -> list[Segment]:
    """The cut of a check resumed after ``last_chunk`` was stored: counting starts anew at the
    last key of the chunk before it, and numbers go on from it. Without one before, the check
    starts at the first key."""
    kept = [s for s in segments if s.chunk < last_chunk]
    if not kept:
        return [Segment(1, 1, size, number)]
    return [*kept, Segment(kept[-1].first_key(last_chunk) - 1, last_chunk, size, number)]


def segment_spans(segments: Sequence[Segment], keys: int) -> list[tuple[Segment, int, int]]:
    """Each segment with the numbers of its first and last key. A segment's first key is also
    the last one of the segment before."""
    ends = [*[s.rn for s in segments[1:]], keys]
    return [(s, s.rn, end) for s, end in zip(segments, ends)]


def with_rank(
    df: DataFrame, order: Sequence[str], ws: Workspace, partitions: int = 0, name: str = "ranked"
) -> DataFrame:
    return numbered(ws.stage(in_order(df, order, partitions), name))


def chunk_number(rank, chunk_size: int, first: int = 1):
    return F.floor((rank - 1) / F.lit(chunk_size)).cast("bigint") + first


def in_chunks(placed: DataFrame, chunk_size: int) -> DataFrame:
    """Staged rows of ``in_order`` with ``rn`` and ``chunk``."""
    return numbered(placed).withColumn("chunk", chunk_number(F.col("rn"), chunk_size))


def chunk_assign(
    keys: DataFrame, pk: str, chunk_size: int, ws: Workspace, partitions: int = 0
) -> DataFrame:
    """Keys, with any columns beside them, plus ``rn`` and ``chunk``."""
    return in_chunks(ws.stage(in_order(keys, [pk], partitions), "keys"), chunk_size)


def chunk_boundaries(chunked: DataFrame, pk: str) -> DataFrame:
    """First key (``upper_boundary``), last key (``lower_boundary``) and size of each chunk."""
    return chunked.groupBy("chunk").agg(
        F.min(pk).alias("upper_boundary"),
        F.max(pk).alias("lower_boundary"),
        F.count("*").alias("keys"),
    )


def chunk_resume(chunked: DataFrame, pk: str, stored: DataFrame, chunk_size: int) -> DataFrame:
    """Keys of the chunks that a resumed check computes again, from the last stored chunk on.

    The last stored chunk M may lack replicas. Counting starts anew at the last key of chunk
    M-1, which so lies in two chunks, and numbers go on from M. Without a chunk before M the
    check starts at the first key.
    """
    last = stored.agg(F.max("chunk")).first()[0]
    before = (
        stored.filter(F.col("chunk") == last - 1).select("lower_boundary").first()
        if last is not None
        else None
    )
    if before is None:
        return chunked
    start = chunked.filter(F.col(pk) == before[0]).select("rn").first()[0]
    rank = F.col("rn") - (start - 1)
    return chunked.filter(F.col(pk) >= before[0]).withColumn(
        "chunk", chunk_number(rank, chunk_size, last)
    )
