"""Attaching small per-group tables to large ones."""

from __future__ import annotations

from pyspark.sql import DataFrame

from relevo.session import materialize


def attach_small(large: DataFrame, small: DataFrame, on: str | list[str], how: str = "inner") -> DataFrame:
    """Join a small table (config rows, per-group statistics) onto a large one.

    The small side is written once to the shared checkpoint folder (its lineage
    may hold a full scan of the large table).  The size of its files is what
    the planner sees: below ``spark.sql.autoBroadcastJoinThreshold`` it is
    broadcast, above it the join is a shuffle join, where AQE splits a hot
    key's partition."""
    return large.join(materialize(small, "small"), on=on, how=how)
