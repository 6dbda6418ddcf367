"""Joining a large table with a lookup table whose size is measured first."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartflow.session import materialise

# A lookup of this many (key, value) rows stays in the tens of megabytes.
BROADCAST_ROWS = 500_000


def lookup_join(df: DataFrame, lookup: DataFrame, on: list[str], how: str = "left",
                max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Join ``df`` with ``lookup`` (unique on ``on``), broadcasting only a counted, small lookup.

    The lookup is checkpointed and counted. Up to ``max_rows`` it is broadcast, so the
    large side is not shuffled; beyond that the join shuffles, and adaptive execution
    splits hot keys of the large side.
    """
    fixed = materialise(lookup)
    small = fixed.count() <= max_rows
    return df.join(F.broadcast(fixed) if small else fixed, on, how)
