"""Log of runs, kept as appended events: a run's last event is its state."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from replicheck.sources.store import literal_rows, read_or_none
from replicheck.spec import ABORTED, STARTED

RUN = "run_id string, table_name string, status int, run_mode int"
EVENT = f"{RUN}, at timestamp"


class RunLog:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.path = f"{root}/run"

    def _events(self, run_id: str, table: str, status: int, run_mode: int) -> DataFrame:
        return literal_rows(self.spark, [(run_id, table, status, run_mode)], RUN)

    def _append(self, events: DataFrame) -> None:
        stamped = events.withColumn("at", F.current_timestamp())
        stamped.coalesce(1).write.mode("append").parquet(self.path)

    def record(self, run_id: str, table: str, status: int, run_mode: int) -> None:
        self._append(self._events(run_id, table, status, run_mode))

    def runs(self) -> DataFrame:
        """One row per run, with its minutes from start to end."""
        events = read_or_none(self.spark, self.path)
        if events is None:
            events = literal_rows(self.spark, [], EVENT)
        return run_states(events)

    def start(self, run_id: str, table: str, run_mode: int) -> None:
        """Record the start. Earlier runs of the table that never ended are marked as aborted."""
        earlier = self.runs().filter(F.col("table_name") == table)
        aborted = stale_runs(earlier, run_id).select(
            "run_id", "table_name", F.lit(ABORTED).alias("status"), "run_mode"
        )
        self._append(aborted.unionByName(self._events(run_id, table, STARTED, run_mode)))


def run_states(events: DataFrame) -> DataFrame:
    """The last event of each run. A run taken for aborted that ends after all has ended."""
    ended = F.col("status") != STARTED
    return (
        events.groupBy("run_id", "table_name")
        .agg(
            F.max_by("status", F.struct("at", "status")).alias("status"),
            F.max("run_mode").alias("run_mode"),
            F.min("at").alias("started"),
            F.max(F.when(ended, F.col("at"))).alias("ended"),
        )
        .withColumn("minutes", F.expr("timestampdiff(MINUTE, started, ended)"))
    )


def stale_runs(runs: DataFrame, current: str) -> DataFrame:
    """Runs that are still marked as started and are not the current one."""
    return runs.filter((F.col("status") == STARTED) & (F.col("run_id") != current))
