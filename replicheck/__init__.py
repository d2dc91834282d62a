"""Check that copies of a table on several nodes agree, and repair them, on Spark."""

from replicheck.spec import CheckConfig, InUse, Refused, ReplicaSpec

__all__ = ["CheckConfig", "InUse", "Refused", "ReplicaSpec"]
