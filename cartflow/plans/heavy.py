"""Joining a large table with a lookup table when a few keys hold much of the large table.

A join by shuffle sends all rows of a key to one task. Here the heavy keys are named first, their lookup
rows are broadcast, so rows of heavy keys are joined where they are read, and only the others are shuffled.
A key is heavy if it has at least one row in ``KEYS`` of the large table, so there are at most ``KEYS`` of them: the
broadcast is bounded by that number, whatever the size of either table.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartflow.session import materialise

KEYS = 2048
_COUNTERS = 4 * KEYS


def heavy_of_counts(counts: DataFrame, on: list[str], n: str, total: int) -> DataFrame:
    """The heavy keys, from a table of exact row counts by key that add up to ``total``."""
    return counts.where((F.col(n) * KEYS >= total) & (F.col(n) > 1)).select(*on)


def heavy_keys(df: DataFrame, on: list[str]) -> DataFrame:
    """The heavy keys of ``df``, by one scan for candidates and one for their exact counts.

    The candidates come from a frequent-items sketch over key hashes (fixed counters, merged map-side).
    ``df`` should be cheap to read twice. Keys with a null are never heavy: they join nothing.
    """
    keyed = df.select(*on).dropna()
    coded = keyed.withColumn("_code", F.xxhash64(*on))
    top = coded.agg(F.count(F.lit(1)).alias("total"), F.expr(f"approx_top_k(_code, {KEYS}, {_COUNTERS})").alias("top"))
    named = materialise(top).select("total", F.explode("top.item").alias("_code"))
    counted = (coded.join(F.broadcast(named), "_code").groupBy(*on)
               .agg(F.count(F.lit(1)).alias("_n"), F.first("total").alias("_total")))
    return materialise(counted.where((F.col("_n") > 1) & (F.col("_n") * KEYS >= F.col("_total"))).select(*on))


def _any_null(on: list[str]) -> Column:
    return reduce(Column.__or__, [F.col(c).isNull() for c in on])


def split_join(facts: DataFrame, lookup: DataFrame, on: list[str], how: str = "left",
               heavy: DataFrame | None = None) -> DataFrame:
    """``facts`` joined (``left`` or ``inner``) with ``lookup``, which is unique on ``on``.

    ``facts`` is read once for each part, so it should be stored. ``heavy`` has the heavy keys, at most ``KEYS`` rows
    (``heavy_of_counts``); without it they are measured. Rows with a null key match nothing and are not shuffled.
    """
    if how not in ("left", "inner"):
        raise ValueError(f"left or inner, not {how}")
    heavy = F.broadcast(heavy_keys(facts, on) if heavy is None else heavy)
    at_once = facts.join(heavy, on, "left_semi").join(F.broadcast(lookup.join(heavy, on, "left_semi")), on, how)
    whole = facts.where(~_any_null(on))
    shuffled = whole.join(heavy, on, "left_anti").join(lookup.join(heavy, on, "left_anti"), on, how)
    parts = at_once.unionByName(shuffled)
    if how == "inner":
        return parts
    added = [F.lit(None).cast(f.dataType).alias(f.name) for f in lookup.schema.fields if f.name not in on]
    return parts.unionByName(facts.where(_any_null(on)).select("*", *added))
