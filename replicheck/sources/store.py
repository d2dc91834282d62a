"""Tables a run keeps: working tables that are cut from lineage, and lasting audit tables."""

from __future__ import annotations

import json
import tempfile
import uuid
from collections.abc import Mapping, Sequence
from functools import cache

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from replicheck.sources.commits import CommitLog


def shared_folder(spark: SparkSession) -> str:
    """The cluster's shared folder, as ``spark.checkpoint.dir`` names it."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return _local_folder().name


@cache
def _local_folder() -> tempfile.TemporaryDirectory:
    """One folder for this process, gone when it ends."""
    return tempfile.TemporaryDirectory(prefix="replicheck-", ignore_cleanup_errors=True)


def read_or_none(spark: SparkSession, path: str, schema: T.StructType | None = None):
    """The Parquet table at ``path``, or None where there is none."""
    try:
        reader = spark.read.schema(schema) if schema is not None else spark.read
        return reader.parquet(path)
    except AnalysisException as e:
        if e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


class Workspace:
    """Working tables of one run, each written once below the shared folder.

    A staged table survives the loss of executors, is read back with column pruning, and its
    size on disk lets Spark decide by itself whether to broadcast it.
    """

    def __init__(self, spark: SparkSession, path: str | None = None):
        self.spark = spark
        self.path = path or f"{shared_folder(spark)}/replicheck/{uuid.uuid4().hex}"
        self._count = 0

    def stage(self, df: DataFrame, name: str) -> DataFrame:
        path = f"{self.path}/{name}-{self._count}"
        self._count += 1
        df.write.mode("overwrite").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def clear(self) -> None:
        """Put an empty table in the place of all staged ones, once nothing reads them."""
        if self._count:
            truncate(self.spark, self.path, T.StructType([T.StructField("nothing", T.LongType())]))
            self._count = 0


def literal_rows(spark: SparkSession, rows: Sequence[Sequence], schema: T.StructType | str):
    """A few facts of the driver as a DataFrame, without a Python worker."""
    fields = (T.StructType.fromDDL(schema) if isinstance(schema, str) else schema).fields
    if not rows:
        blank = [F.lit(None).cast(f.dataType).alias(f.name) for f in fields]
        return spark.range(0).select(*blank)
    entries = [
        F.struct(*[F.lit(v).cast(f.dataType).alias(f.name) for f, v in zip(fields, row)])
        for row in rows
    ]
    return spark.range(1, numPartitions=1).select(F.inline(F.array(*entries)))


def truncate(spark: SparkSession, path: str, schema: T.StructType) -> None:
    literal_rows(spark, [], schema).write.mode("overwrite").parquet(path)


class AuditStore:
    """Audit tables of one checked table below ``root``, as the log of commits has them.

    ``matrix``, ``keys``, ``chunk`` and ``chunk_differ`` live during a check and are emptied
    after it. ``differ`` and its ``outcome`` only grow: a status is updated by appending the
    outcome and joining it in on read. ``backup`` holds rows as they were before their repair.
    """

    WORKING = ("matrix", "keys", "chunk", "chunk_differ")

    def __init__(self, spark: SparkSession, root: str, table: str, owner: str | None = None):
        self.spark = spark
        self.root = root
        self.table = table
        self.log = CommitLog(spark, root, table, owner)

    def folder(self, name: str, transaction: str) -> str:
        return f"{self.root}/{name}/table_name={self.table}/part={transaction}"

    def write(self, name: str, df: DataFrame, transaction: str) -> tuple[str, dict]:
        """Write a part. It counts once it is committed."""
        kept, folder = df.drop("table_name"), self.folder(name, transaction)
        kept.write.mode("overwrite").parquet(folder)
        return folder, json.loads(kept.schema.json())

    def commit(
        self,
        transaction: str,
        parts: Mapping[str, DataFrame] | None = None,
        clear: Sequence[str] = (),
        facts: Mapping[str, object] | None = None,
    ) -> None:
        """Write parts and commit them together; parts that are live no more are deleted. A
        transaction that was committed before changes nothing."""
        if transaction in self.log.state().done:
            return
        added = {name: self.write(name, df, transaction) for name, df in (parts or {}).items()}
        for folder in self.log.commit(transaction, added, clear, facts) or ():
            self.log.files.delete(folder)

    def overwrite(self, name: str, df: DataFrame) -> DataFrame:
        self.commit(uuid.uuid4().hex, {name: df}, clear=[name])
        return self.read(name)

    def append(self, name: str, df: DataFrame, transaction: str | None = None) -> None:
        """Append rows; the same transaction appends only once."""
        self.commit(transaction or uuid.uuid4().hex, {name: df})

    def read(self, name: str) -> DataFrame | None:
        """Rows of all committed parts; None where none was ever committed."""
        state = self.log.state()
        if name not in state.schemas:
            return None
        schema = T.StructType.fromJson(state.schemas[name])
        folders = state.parts[name]
        if folders:
            df = self.spark.read.schema(schema).parquet(*folders)
        else:
            df = literal_rows(self.spark, [], schema)
        return df.withColumn("table_name", F.lit(self.table))

    def facts(self, name: str):
        return self.log.state().facts.get(name)

    def clear_working_tables(self, names: Sequence[str] = WORKING) -> None:
        self.commit(uuid.uuid4().hex, clear=names)

    def sweep(self) -> None:
        """Delete parts that no commit names: what runs that broke off have left. Only the
        table's owner may do it."""
        state = self.log.state()
        files = self.log.files
        for name in files.names(self.root):
            base = f"{self.root}/{name}/table_name={self.table}"
            live = {f.rpartition("/")[2] for f in state.parts.get(name, ())}
            for part in files.names(base):
                if part.startswith("part=") and part not in live:
                    files.delete(f"{base}/{part}")

    def backup_name(self, schema: T.StructType) -> str:
        """The audit table for backups of this shape. Another shape gets another one, so that
        earlier backups stay as they are."""
        return f"backup-{uuid.uuid5(uuid.NAMESPACE_OID, schema.simpleString()).hex[:12]}"

    def backups(self, schema: T.StructType) -> DataFrame | None:
        df = self.read(self.backup_name(schema))
        return None if df is None else df.drop("table_name")
