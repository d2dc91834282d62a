"""Pre-flight checks: each gives violations or facts as rows."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from itertools import zip_longest

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from replicheck.functions.times import bad_time
from replicheck.sources.readers import read_replica
from replicheck.sources.store import literal_rows
from replicheck.spec import Refused, ReplicaSpec

# Columns a backup has after those of the table.
BACKUP_COLUMNS = (
    T.StructField("source_dn", T.StringType()),
    T.StructField("repair_standard", T.IntegerType()),
    T.StructField("differ_id", T.LongType()),
)


# Names that columns of the work have; a table's own must not be in their way.
RESERVED = ("ord", "datanode", "op", *(f.name for f in BACKUP_COLUMNS))
RESERVED_KEYS = (
    "chunk", "rn", "place", "row_crc", "t", "uk", "winner", "status", "differ_type", "table_name"
)


def reserved_names(columns: Sequence[str], pk: str) -> list[str]:
    """Columns to be renamed on reading before the table can be compared."""

    def in_the_way(c: str) -> bool:
        taken = c.lower() in RESERVED or (c == pk and c.lower() in RESERVED_KEYS)
        return taken or c.startswith("_") or "." in c or "`" in c

    return [c for c in columns if in_the_way(c)]


def read_if_there(spark: SparkSession, spec: ReplicaSpec) -> DataFrame | None:
    """A replica's table, or None where there is none that can be read."""
    try:
        df = read_replica(spark, spec)
        return df if df.schema is not None else None
    except AnalysisException as e:
        if e.getCondition() in ABSENT:
            return None
        raise


# Error conditions that mean there is no table.
ABSENT = ("TABLE_OR_VIEW_NOT_FOUND", "PATH_NOT_FOUND", "SCHEMA_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA")


def table_on_all_replicas(spark: SparkSession, specs: Sequence[ReplicaSpec]) -> DataFrame:
    """Whether each replica's table can be read: ``(ord, datanode, exists)``."""
    found = [(s.ord, s.datanode, read_if_there(spark, s) is not None) for s in specs]
    return literal_rows(spark, found, "ord int, datanode string, exists boolean")


def unlike_columns(replicas: Sequence[tuple[int, str, DataFrame]]) -> list[tuple]:
    """Columns whose place or type is not the first replica's: ``(ord, datanode, position,
    expected name and type, found name and type)``."""

    def fields(df: DataFrame) -> list[tuple[str, str]]:
        return [(f.name, f.dataType.simpleString()) for f in df.schema.fields]

    expected, nothing, unlike = fields(replicas[0][2]), (None, None), []
    for ord, dn, df in replicas[1:]:
        pairs = zip_longest(expected, fields(df), fillvalue=nothing)
        for at, (want, have) in enumerate(pairs, start=1):
            if want != have:
                unlike.append((ord, dn, at, *want, *have))
    return unlike


@dataclass(frozen=True)
class Declared:
    """What the catalogue declares of a column beside its type."""

    nullable: bool
    default: str | None


def catalogue_columns(spark: SparkSession, spec: ReplicaSpec) -> dict[str, Declared] | None:
    """Columns of a replica as its catalogue declares them; None where it lies in none or is a
    view."""
    if spec.reader is not None or spec.format != "table":
        return None
    try:
        told = json.loads(spark.sql(f"DESCRIBE TABLE EXTENDED {spec.source} AS JSON").first()[0])
    except AnalysisException:  # a catalogue that cannot tell
        return None
    if "VIEW" in told.get("type", "VIEW"):
        return None
    return {
        c["name"]: Declared(c.get("nullable", True), c.get("default"))
        for c in told["columns"]
    }


def unlike_declarations(
    replicas: Sequence[tuple[str, Mapping[str, Declared] | None]],
) -> list[tuple[str, str, str, str, str]]:
    """Columns declared otherwise than on the first replica that lies in a catalogue:
    ``(datanode, column, what, expected, found)``."""
    known = [(dn, columns) for dn, columns in replicas if columns is not None]
    unlike = []
    for dn, columns in known[1:]:
        for name, want in known[0][1].items():
            have = columns.get(name)
            if have is None:
                continue  # a matter of ``unlike_columns``
            if want.nullable != have.nullable:
                says = {True: "NULL", False: "NOT NULL"}
                unlike.append((dn, name, "nullability", says[want.nullable], says[have.nullable]))
            if want.default != have.default:
                unlike.append((dn, name, "default", str(want.default), str(have.default)))
    return unlike


def schema_equal(spark: SparkSession, replicas: Sequence[tuple[int, str, DataFrame]]) -> DataFrame:
    """One row per column that is not as on the first replica."""
    return literal_rows(
        spark,
        unlike_columns(replicas),
        "ord int, datanode string, position int, expected_name string, expected_type string, "
        "found_name string, found_type string",
    )


def pk_single(rows: DataFrame, pk: str) -> DataFrame:
    """Per replica: rows, distinct keys, NULL keys, and whether the column is a key."""
    per_key = rows.groupBy("ord", pk).agg(F.count("*").alias("n"))
    facts = per_key.groupBy("ord").agg(
        F.sum("n").alias("cnt"),
        F.count(pk).alias("keys"),
        F.sum(F.when(F.col(pk).isNull(), F.col("n")).otherwise(0)).alias("null_keys"),
    )
    return facts.withColumn("is_key", (F.col("cnt") == F.col("keys")) & (F.col("null_keys") == 0))


def key_faults(matrix: DataFrame, pk: str, ords: Sequence[int]) -> DataFrame:
    """NULL keys, and keys that one replica holds more than once, found in the key matrix."""
    repeated = F.greatest(F.lit(0), *[F.col(f"cnt_{o}") for o in ords]) > 1
    return matrix.filter(F.col(pk).isNull() | repeated).select(pk)


def pk_type(rows: DataFrame, pk: str, stored: T.StructType | None = None) -> DataFrame:
    """Declared type of the key on each replica, and whether keys stored by an earlier run
    have the same."""
    declared = rows.schema[pk].dataType
    kept = stored[pk].dataType if stored is not None and pk in stored.names else None
    return rows.groupBy("ord").agg(
        F.first(F.lit(declared.simpleString())).alias("pk_type"),
        F.first(F.lit(kept is None or kept == declared)).alias("as_stored"),
        F.count("*").alias("cnt"),
    )


def refuse_unique_keys(unique_keys: Sequence[Sequence[str]], repairs: bool) -> tuple[str, ...]:
    """The one unique key a repair can keep, or none."""
    if repairs and len(unique_keys) > 1:
        raise Refused("more than one unique key: run in a check mode instead")
    return tuple(unique_keys[0]) if unique_keys else ()


def unique_key_rule(rows: DataFrame, unique_cols: Sequence[str]) -> DataFrame:
    """Per replica: tuples without NULL, distinct ones, and whether they are unique."""
    full = F.lit(True)
    for c in unique_cols:
        full = full & F.col(c).isNotNull()
    per_tuple = rows.filter(full).groupBy("ord", *unique_cols).agg(F.count("*").alias("n"))
    return (
        per_tuple.groupBy("ord")
        .agg(F.sum("n").alias("tuples"), F.count("*").alias("distinct_tuples"))
        .withColumn("is_unique", F.col("tuples") == F.col("distinct_tuples"))
    )


def time_column_exists(
    replicas: Sequence[tuple[int, str, DataFrame]], time_column: str
) -> list[tuple[int, str, bool]]:
    return [(ord, dn, time_column in df.columns) for ord, dn, df in replicas]


def time_format_probe(rows: DataFrame, time_column: str, time_format: str) -> DataFrame:
    """Per replica: rows, and rows whose time is NULL or does not read as declared."""
    bad = bad_time(time_column, rows.schema[time_column].dataType, time_format)
    return rows.groupBy("ord").agg(F.count("*").alias("cnt"), F.count_if(bad).alias("bad"))


def empty_table_guard(rows: DataFrame) -> bool:
    """True where no replica holds a row."""
    return rows.limit(1).isEmpty()


def checksum_columns(schema: T.StructType, exclude: Sequence[str]) -> list[str]:
    """Columns that enter the checksum, in declared order."""
    return [n for n in schema.names if n not in ("ord", "datanode") and n not in set(exclude)]


def nullable_columns(
    schema: T.StructType,
    columns: Sequence[str],
    declared: Sequence[str] | None = None,
    catalogue: Mapping[str, Declared] | None = None,
) -> list[str]:
    """Columns with a NULL flag: those declared, else those of the catalogue. Parquet reads call
    every column nullable: declare them."""
    if declared is not None:
        return [c for c in columns if c in set(declared)]
    if catalogue is not None:
        return [c for c in columns if c not in catalogue or catalogue[c].nullable]
    return [c for c in columns if schema[c].nullable]


def undeclared_nulls(rows: DataFrame, columns: Sequence[str], nullable: Sequence[str]) -> DataFrame:
    """Per checksum column: whether it is declared nullable, and the NULLs found in it."""
    counts = rows.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    entries = [
        F.struct(
            F.lit(c).alias("column_name"),
            F.lit(c in set(nullable)).alias("nullable"),
            F.col(c).alias("nulls"),
        )
        for c in columns
    ]
    return counts.select(F.inline(F.array(*entries)))


def undeclared_null_faults(
    rows: DataFrame, columns: Sequence[str], nullable: Sequence[str]
) -> DataFrame:
    """NULLs in checksum columns that are not declared nullable: ``(ord, column_name, nulls)``.
    The row text skips a NULL without a mark there, so unlike rows could look equal."""
    watched = [c for c in columns if c not in set(nullable)]
    if not watched:
        return rows.select("ord", F.lit("").alias("column_name"), F.lit(0).alias("nulls")).limit(0)
    counts = rows.groupBy("ord").agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in watched])
    entries = [F.struct(F.lit(c).alias("column_name"), F.col(c).alias("nulls")) for c in watched]
    return counts.select("ord", F.inline(F.array(*entries))).filter("nulls > 0")


def unknown_columns(columns: Sequence[str], named: Mapping[str, Sequence[str]]) -> list[str]:
    """Names in the configuration that the table lacks, as ``parameter: name``."""
    return [f"{what}: {c}" for what, cs in named.items() for c in cs if c not in set(columns)]


def pending_key_faults(found: DataFrame, pk: str) -> DataFrame:
    """Among rows found for pending keys, those whose key is NULL or repeats on its replica."""
    per_key = found.groupBy("ord", pk).agg(F.count("*").alias("cnt"))
    return per_key.filter(F.col(pk).isNull() | (F.col("cnt") > 1))


def backup_schema(schema: T.StructType) -> T.StructType:
    """The table's columns without keys, followed by source, standard mark and entry id."""
    fields = [f for f in schema.fields if f.name not in ("ord", "datanode")]
    own = [T.StructField(f.name, f.dataType, True) for f in fields]
    return T.StructType([*own, *BACKUP_COLUMNS])


def backup_schema_drift(schema: T.StructType, stored: T.StructType | None) -> bool:
    """Whether a stored backup has another shape than the live table's backup would have."""
    shape = [(f.name, f.dataType) for f in backup_schema(schema).fields]
    return stored is not None and [(f.name, f.dataType) for f in stored.fields] != shape
