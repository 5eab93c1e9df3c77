"""Fact-to-dimension joins.

Policy
* A dimension whose row count is bounded *by construction* (the calendar: one
  row per day of a fixed range) is broadcast explicitly.
* Every other dimension grows with the data (patients, hospitals, diseases…),
  so no hint is given: the planner broadcasts it only while its estimated size
  is under ``spark.sql.autoBroadcastJoinThreshold`` (left at the cluster's
  value, Spark's default 10 MB) and otherwise plans a
  shuffle join; AQE re-plans at run time from the real sizes and splits skewed
  partitions (``spark.sql.adaptive.skewJoin.enabled``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Upper bound on rows for which an explicit broadcast is allowed.
MAX_BROADCAST_ROWS = 1_000_000


def join_dim(fact: DataFrame, dim: DataFrame, on, how: str = "inner", bounded_rows: int | None = None) -> DataFrame:
    """Join ``fact`` with ``dim``; broadcast only with a proven row bound."""
    if bounded_rows is not None and bounded_rows <= MAX_BROADCAST_ROWS:
        dim = F.broadcast(dim)
    return fact.join(dim, on=on, how=how)


def bounded(dim: DataFrame, rows: int) -> DataFrame:
    """``dim`` with a broadcast hint while its proven row bound allows one."""
    return F.broadcast(dim) if rows <= MAX_BROADCAST_ROWS else dim
