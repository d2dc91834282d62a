"""Whole jobs built from the operators."""

from replicheck.plans.job import RunResult, add_pending, run, run_tables

__all__ = ["RunResult", "add_pending", "run", "run_tables"]
