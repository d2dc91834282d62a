"""Reading replicas and keeping tables of a run."""

from replicheck.sources.readers import (
    jdbc_replica,
    key_lookup_rows,
    key_range_scan,
    key_scan,
    read_replica,
    read_replicas,
    union_replicas,
    unique_cols_lookup,
)
from replicheck.sources.store import AuditStore, Workspace, literal_rows

__all__ = [
    "AuditStore",
    "Workspace",
    "jdbc_replica",
    "key_lookup_rows",
    "key_range_scan",
    "key_scan",
    "literal_rows",
    "read_replica",
    "read_replicas",
    "union_replicas",
    "unique_cols_lookup",
]
