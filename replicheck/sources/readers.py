"""Scans over the copies of a table."""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from replicheck.spec import ReplicaSpec

# Places in the table of bits that keeps rows nobody asks for out of a shuffle: 4 MB at most,
# whatever the number of keys. Beyond about as many keys it lets every row through.
BITS = 1 << 25

# Formats whose rows know the file they come from.
FILE_FORMATS = ("parquet", "orc", "csv", "json")
# The column that names it; names of a table's own columns do not begin like this.
FILE = "_file"


def read_replica(spark: SparkSession, spec: ReplicaSpec) -> DataFrame:
    """One copy as it is stored, with its own columns only."""
    if spec.reader is not None:
        return spec.reader(spark)
    if spec.format == "table":
        return spark.table(spec.source)
    reader = spark.read.format(spec.format).options(**spec.options)
    if spec.schema:
        reader = reader.schema(spec.schema)
    return reader.load(spec.source) if spec.source else reader.load()


def in_files(spec: ReplicaSpec) -> bool:
    return spec.reader is None and spec.format in FILE_FORMATS and spec.source is not None


def with_file(df: DataFrame, spec: ReplicaSpec) -> DataFrame:
    """A copy with the file each row lies in, NULL where that is not known."""
    file = F.col("_metadata.file_path") if in_files(spec) else F.lit(None).cast("string")
    return df.withColumn(FILE, file)


def files_of(df: DataFrame) -> list[str]:
    """The files a copy lies in, spelled as ``with_file`` does."""
    return [re.sub("^([^:/]+):///", r"\1:/", f) for f in df.inputFiles()]


def read_files(
    spark: SparkSession, spec: ReplicaSpec, schema: T.StructType, files: Iterable[str]
) -> DataFrame:
    """Rows of some files of a copy, as ``with_file`` names them."""
    paths = [unquote(f) for f in files]
    reader = spark.read.format(spec.format).options(**spec.options).schema(schema)
    folder = spec.source.rstrip("/").rpartition("/")[2]
    if any(p.split("/")[-2] != folder and p.split("/")[-1] != folder for p in paths):
        reader = reader.option("basePath", spec.source)  # folders below name columns
    if not paths:
        return reader.load(spec.source).filter(F.lit(False))
    return reader.load(paths)


def snapshots(spark: SparkSession, specs: Sequence[ReplicaSpec]) -> dict[int, str]:
    """What identifies the stored state of each copy by its ``ord``: the number of its files, and
    a digest of their paths, sizes and times. Copies that lie in no files have none."""
    found = []
    for spec in specs:
        files = [unquote(f) for f in files_of(read_replica(spark, spec))]
        if files:
            listed = spark.read.format("binaryFile").load(files)
            digest = F.hex(F.bit_xor(F.xxhash64("path", "length", "modificationTime")))
            found.append(
                listed.agg(
                    F.lit(spec.ord).alias("ord"),
                    F.concat_ws(":", F.count("*"), F.sum("length"), digest).alias("snapshot"),
                )
            )
    rows = reduce(DataFrame.unionByName, found).collect() if found else []
    return {r["ord"]: r["snapshot"] for r in rows}


def jdbc_replica(
    ord: int,
    datanode: str,
    url: str,
    table: str,
    pk: str,
    bounds: tuple[int, int],
    partitions: int,
    fetchsize: int = 1000,
    **options: str,
) -> ReplicaSpec:
    """A copy behind a database connection, read in ``partitions`` ranges of a numeric key."""
    jdbc = {
        "url": url,
        "dbtable": table,
        "partitionColumn": pk,
        "lowerBound": str(bounds[0]),
        "upperBound": str(bounds[1]),
        "numPartitions": str(partitions),
        "fetchsize": str(fetchsize),
        **options,
    }
    return ReplicaSpec(ord=ord, datanode=datanode, format="jdbc", options=jdbc)


def tag(df: DataFrame, spec: ReplicaSpec) -> DataFrame:
    return df.select(
        F.lit(spec.ord).cast("int").alias("ord"), F.lit(spec.datanode).alias("datanode"), "*"
    )


def union_replicas(copies: Sequence[tuple[ReplicaSpec, DataFrame]]) -> DataFrame:
    return reduce(DataFrame.unionByName, [tag(df, spec) for spec, df in copies])


def read_replicas(spark: SparkSession, specs: Sequence[ReplicaSpec]) -> DataFrame:
    """All copies as one DataFrame ``(ord, datanode, *columns)``."""
    return union_replicas([(s, read_replica(spark, s)) for s in specs])


def key_scan(rows: DataFrame, pk: str) -> DataFrame:
    return rows.select("ord", pk)


def key_range_scan(rows: DataFrame, pk: str, low, high) -> DataFrame:
    """Rows with ``low <= pk <= high``; the bounds reach the source."""
    return rows.filter(F.col(pk).between(low, high))


def key_lookup_rows(rows: DataFrame, pending: DataFrame, pk: str) -> DataFrame:
    """Whole rows of the pending keys, on every replica that holds them.

    The keys' range reaches the source, and a table of bits made from the keys is tested in the
    scan's own stage, so a join that shuffles moves hardly more wide rows than it returns.
    """
    keys = pending.select(pk).filter(F.col(pk).isNotNull())
    low, high = keys.agg(F.min(pk), F.max(pk)).first()
    if low is None:
        return rows.filter(F.lit(False))
    likely = likely_rows(key_range_scan(rows, pk, low, high), keys, pk)
    # an inner join with distinct keys: Spark would move a semi join below the test of bits
    return likely.join(keys.distinct(), pk).select(*rows.columns)


def located_rows(
    spark: SparkSession,
    copies: Sequence[tuple[ReplicaSpec, DataFrame]],
    pending: DataFrame,
    pk: str,
    current: dict[int, str],
    collation: str | None = None,
) -> DataFrame:
    """The same rows with their files, for pending keys that carry in ``files`` where a check
    saw them, as ``(ord, snapshot, file)``.

    A key is looked up in its own files while every copy still is what the check saw; copies
    that hold it in no file are not read for it. Other keys are looked up by a scan.
    """
    everything = collate(union_replicas([(s, with_file(df, s)) for s, df in copies]), pk, collation)
    if any(not in_files(s) or s.ord not in current for s, _ in copies):
        return key_lookup_rows(everything, pending, pk)
    identity = [F.struct(F.lit(s.ord).alias("ord"), F.lit(current[s.ord]).alias("snapshot")) for s, _ in copies]
    seen = F.transform("files", lambda f: F.struct(f["ord"].alias("ord"), f["snapshot"].alias("snapshot")))
    known = F.coalesce(F.size(F.array_except(F.array(*identity), seen)) == 0, F.lit(False))
    split = pending.select(pk, "files", known.alias("known"))
    listed = (
        split.filter("known")
        .select(F.inline("files"))
        .filter("file is not null")
        .select("ord", "file")
        .distinct()
    )
    hashes = {(r["ord"], r["file"]) for r in listed.collect()}
    parts = []
    rest = split.filter(~F.col("known"))
    if not rest.isEmpty():
        parts.append(key_lookup_rows(everything, rest, pk))
    if hashes:
        near = []
        for spec, df in copies:
            named = spark.createDataFrame([(f,) for f in files_of(df)], "file string")
            hashed = named.select("file", F.xxhash64("file").alias("hash")).collect()
            files = [r["file"] for r in hashed if (spec.ord, r["hash"]) in hashes]
            near.append((spec, with_file(read_files(spark, spec, df.schema, files), spec)))
        rows = collate(union_replicas(near), pk, collation)
        parts.append(key_lookup_rows(rows, split.filter("known"), pk))
    return reduce(DataFrame.unionByName, parts) if parts else everything.filter(F.lit(False))


def collate(rows: DataFrame, pk: str, collation: str | None) -> DataFrame:
    """Let a string key compare, sort and group by ``collation``."""
    return rows.withColumn(pk, F.collate(pk, collation)) if collation else rows


def likely_rows(rows: DataFrame, keys: DataFrame, pk: str) -> DataFrame:
    """Rows whose key may be among ``keys``: all that are, and few others while there are far
    fewer keys than ``BITS``. Keys under a collation are not told apart by their bytes: all rows."""
    kind = rows.schema[pk].dataType
    if isinstance(kind, T.StringType) and kind != T.StringType():
        return rows
    slot = F.pmod(F.xxhash64(pk), F.lit(BITS))
    bits = (
        keys.select(slot.alias("__slot"))
        .groupBy(F.expr("bitmap_bucket_number(__slot)").alias("__bucket"))
        .agg(F.expr("bitmap_construct_agg(bitmap_bit_position(__slot))").alias("__bits"))
    )
    placed = rows.withColumn("__slot", slot).withColumns(
        {
            "__bucket": F.expr("bitmap_bucket_number(__slot)"),
            "__place": F.expr("bitmap_bit_position(__slot)"),
        }
    )
    # as numbers, made once a bucket: rows are tested without a string of each
    last = (1 << 12) // 8 - 1  # of a bucket's 4096 bytes
    word = "cast(conv(hex(substring(__bits, 8 * i + 1, 8)), 16, -10) as bigint)"
    words = bits.select("__bucket", F.expr(f"transform(sequence(0, {last}), i -> {word})").alias("__words"))
    # a word begins with its first byte, and a byte's first place is its lowest bit
    is_set = F.expr(
        "getbit(__words[cast(__place div 64 as int)], "
        "cast(56 - 8 * (__place div 8 % 8) + __place % 8 as int)) = 1"
    )
    return placed.join(F.broadcast(words), "__bucket").filter(is_set).select(*rows.columns)


def unique_cols_lookup(
    rows: DataFrame, pending: DataFrame, pk: str, unique_cols: Sequence[str]
) -> DataFrame:
    """Values of the unique columns for the pending keys on every replica."""
    return key_lookup_rows(rows.select("ord", pk, *unique_cols), pending, pk)
