"""What is checked: the replicas, the table's keys, and the job's parameters."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

# Status of a differing key.
PENDING, REPAIRED, DELETED, LOCK_FAILED, FAILED, MANUAL = 0, 1, 2, 3, 4, 5
# Type of a difference.
MISSING, UNLIKE, UNIQUE_CONFLICT = 1, 2, 3
# Status of a run.
STARTED, ENDED, ABORTED, EMPTY_TABLE, NO_KEYS, OVER_LIMIT, FAILED_RUN = 0, 1, 2, 4, 5, 7, 8
# Run modes.
CHECK_AND_REPAIR, CHECK_ONLY, REPAIR_ONLY, RESUME_CHECK = 0, 1, 2, 3


class Refused(ValueError):
    """The table cannot be compared or repaired as configured; nothing was changed."""


class InUse(Refused):
    """Another run works on the table."""


@dataclass(frozen=True)
class ReplicaSpec:
    """One copy of the table. ``ord`` is its place in the declared order, which decides
    first anomalies and ties. The copy is read from ``source`` with ``format`` and ``options``,
    or by ``reader`` where a DataFrame is at hand.
    """

    ord: int
    datanode: str
    source: str | None = None
    format: str = "parquet"
    options: Mapping[str, str] = field(default_factory=dict)
    schema: str | None = None  # of files that carry none, as DDL
    reader: Callable[[SparkSession], DataFrame] | None = None


def match_replicas(
    nodes: Iterable[tuple[str, str, str]], hosts: Mapping[str, str], format: str = "parquet"
) -> list[ReplicaSpec]:
    """Specs for declared ``(datanode, host, table path)`` nodes, in declared order.

    ``hosts`` maps a host name to the location its tables lie under. A node whose host is
    not declared is dropped.
    """
    known = [(dn, hosts[host], table) for dn, host, table in nodes if host in hosts]
    return [
        ReplicaSpec(ord=i, datanode=dn, source=f"{base}/{table}", format=format)
        for i, (dn, base, table) in enumerate(known, start=1)
    ]


@dataclass(frozen=True)
class CheckConfig:
    """Parameters of one table's run. Bad values raise ``ValueError`` at construction."""

    table: str
    pk: str
    replicas: tuple[ReplicaSpec, ...]
    root: str = ""  # a lasting folder for audit tables and backups; a job refuses none
    run_mode: int = CHECK_AND_REPAIR
    chunk_size: int = 1000
    range_keys: int = 0  # keys of a range whose chunks are committed; 0 makes ranges by itself
    take_over: bool = False  # end the run that owns the audit tables, if one does
    parallel: int = 0  # partitions of the key ordering; 0 leaves the number to Spark
    auto_repair_size: int = 1000  # most keys repaired without asking; 0 sets no limit
    time_column: str | None = None
    time_format: str = "str"
    unique_keys: tuple[tuple[str, ...], ...] = ()
    verify_unique: bool = False  # before a repair, on whole replicas
    exclude_columns: tuple[str, ...] | None = None  # None leaves out the time column
    nullable_columns: tuple[str, ...] | None = None  # None takes the schema's word
    decimals: Mapping[str, tuple[int, int]] = field(default_factory=dict)
    fraction_digits: Mapping[str, int] = field(default_factory=dict)
    collation: str | None = None
    algo: str = "crc32"
    write_replicas: bool = False  # write every copy anew instead of a change set beside it

    def __post_init__(self) -> None:
        checks = [
            (bool(self.table) and bool(self.pk), "table and pk are needed"),
            (len(self.replicas) >= 1, "at least one replica is needed"),
            (self.run_mode in (0, 1, 2, 3), f"run_mode {self.run_mode} is not one of 0, 1, 2, 3"),
            (self.chunk_size >= 1, "chunk_size must be at least 1"),
            (self.range_keys >= 0, "range_keys must not be negative"),
            (self.parallel >= 0, "parallel must not be negative"),
            (self.auto_repair_size >= 0, "auto_repair_size must not be negative"),
            (self.time_format in ("str", "int"), "time_format must be 'str' or 'int'"),
            (self.algo in ("crc32", "xxhash64"), "algo must be 'crc32' or 'xxhash64'"),
        ]
        ords = [r.ord for r in self.replicas]
        names = [r.datanode for r in self.replicas]
        checks.append((len(set(ords)) == len(ords) == len(set(names)), "replicas must be distinct"))
        problems = [text for ok, text in checks if not ok]
        if problems:
            raise ValueError("; ".join(problems))

    @property
    def nodes(self) -> list[tuple[int, str]]:
        """``(ord, datanode)`` in declared order."""
        return sorted((r.ord, r.datanode) for r in self.replicas)

    @property
    def named_columns(self) -> dict[str, list[str]]:
        """Columns that parameters name, by parameter."""
        return {
            "nullable_columns": list(self.nullable_columns or ()),
            "exclude_columns": list(self.exclude_columns or ()),
            "decimals": list(self.decimals),
            "fraction_digits": list(self.fraction_digits),
            "unique_keys": [c for key in self.unique_keys for c in key],
            "time_column": [self.time_column] if self.time_column else [],
        }

    @property
    def repairs(self) -> bool:
        return self.run_mode in (CHECK_AND_REPAIR, REPAIR_ONLY)

    @property
    def excluded(self) -> tuple[str, ...]:
        if self.exclude_columns is not None:
            return tuple(self.exclude_columns)
        return (self.time_column,) if self.time_column else ()
