"""Checksums of rows, keys, chunks and whole tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from replicheck.functions.text import crc_hex, row_text, text_crc, typed_hash
from replicheck.operators.keys import chunk_assign
from replicheck.sources.store import Workspace

Nodes = Sequence[tuple[int, str]]


def row_checksums(
    rows: DataFrame,
    pk: str,
    columns: Sequence[str],
    nullable: Sequence[str],
    decimals: Mapping[str, tuple[int, int]] | None = None,
    fraction_digits: Mapping[str, int] | None = None,
    algo: str = "crc32",
    watched: Sequence[str] = (),
    file: str | None = None,
) -> DataFrame:
    """``(ord, pk, row_crc)`` of every row: wide columns end in the scan's own stage. With
    ``watched`` columns also ``nulls_0, ...``: bits that say which of them are NULL. With a
    ``file`` column also its hash, to know where the row lies."""
    if algo == "crc32":
        value = text_crc(row_text(rows.schema, columns, nullable, decimals, fraction_digits))
    else:
        value = typed_hash(columns)
    where = [F.when(F.col(file).isNotNull(), F.xxhash64(file)).alias("_file")] if file else []
    return rows.select("ord", pk, value.alias("row_crc"), *null_bits(watched), *where)


# Bits of a long that stand for a column each.
NULL_BITS = 62


def null_bits(watched: Sequence[str]) -> list[Column]:
    out = []
    for at in range(0, len(watched), NULL_BITS):
        bits = F.lit(0).cast("long")
        for k, c in enumerate(watched[at : at + NULL_BITS]):
            bits = bits + F.when(F.col(c).isNull(), F.lit(1 << k).cast("long")).otherwise(0)
        out.append(bits.alias(f"nulls_{at // NULL_BITS}"))
    return out


def null_columns(matrix: DataFrame, watched: Sequence[str]) -> list[str]:
    """Watched columns in which a row of any replica was NULL."""
    if not watched:
        return []
    names = [n for n in matrix.columns if n.startswith("nulls_")]
    bits = matrix.agg(*[F.bit_or(n).alias(n) for n in names]).first()
    return [c for k, c in enumerate(watched) if (bits[k // NULL_BITS] or 0) >> k % NULL_BITS & 1]


def key_matrix(row_crcs: DataFrame, pk: str, nodes: Nodes) -> DataFrame:
    """One row per key with every replica's row count and folded checksum beside each other.

    One shuffle, combined on the map side, gives the key universe and the values of all
    replicas for it: no later step joins replicas to keys.
    """
    folds = []
    for ord, _ in nodes:
        here = F.col("ord") == ord
        folds += [
            F.count(F.when(here, 1)).alias(f"cnt_{ord}"),
            F.bit_xor(F.when(here, F.col("row_crc"))).alias(f"crc_{ord}"),
        ]
        if "_file" in row_crcs.columns:
            folds.append(F.max(F.when(here, F.col("_file"))).alias(f"_file_{ord}"))
    folds += [F.bit_or(n).alias(n) for n in row_crcs.columns if n.startswith("nulls_")]
    return row_crcs.groupBy(pk).agg(*folds)


def per_replica(df: DataFrame, nodes: Nodes, keep: Sequence[Column | str]) -> DataFrame:
    """The replicas' columns beside each other as one row per replica."""
    entries = [
        F.struct(
            F.lit(ord).cast("int").alias("ord"),
            F.lit(dn).alias("datanode"),
            crc_hex(F.col(f"crc_{ord}")).alias("crc"),
            F.col(f"cnt_{ord}").alias("cnt"),
        )
        for ord, dn in nodes
    ]
    return df.select(*keep, F.inline(F.array(*entries)))


def _folded(nodes: Nodes) -> list[Column]:
    return [
        fold
        for ord, _ in nodes
        for fold in (
            F.sum(f"cnt_{ord}").alias(f"cnt_{ord}"),
            F.bit_xor(f"crc_{ord}").alias(f"crc_{ord}"),
        )
    ]


def chunk_checksum(chunked: DataFrame, pk: str, nodes: Nodes, table: str) -> DataFrame:
    """Row count and checksum of each chunk on each replica, also where it holds no row."""
    chunks = chunked.groupBy("chunk").agg(
        F.min(pk).alias("upper_boundary"), F.max(pk).alias("lower_boundary"), *_folded(nodes)
    )
    named = [F.lit(table).alias("table_name"), "chunk", "upper_boundary", "lower_boundary"]
    return per_replica(chunks, nodes, named)


def chunk_upsert(stored: DataFrame, new: DataFrame) -> DataFrame:
    """Stored chunk rows with the new ones in their place, by (replica, table, chunk)."""
    key = ["datanode", "table_name", "chunk"]
    return stored.join(new.select(*key), key, "left_anti").unionByName(new)


def table_checksum(row_crcs: DataFrame) -> DataFrame:
    """Row count and checksum of each whole replica."""
    return row_crcs.groupBy("ord").agg(
        F.count("*").alias("cnt"), crc_hex(F.bit_xor("row_crc")).alias("crc")
    )


def chunk_keys(
    rows: DataFrame,
    pk: str,
    columns: Sequence[str],
    nullable: Sequence[str],
    nodes: Nodes,
    chunk_size: int,
    ws: Workspace,
    partitions: int = 0,
    **text,
) -> DataFrame:
    """From the replicas' rows to the chunked key matrix: one scan, staged, then one sort."""
    matrix = ws.stage(
        key_matrix(row_checksums(rows, pk, columns, nullable, **text), pk, nodes), "matrix"
    )
    return chunk_assign(matrix, pk, chunk_size, ws, partitions)
