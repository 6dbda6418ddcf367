"""Counting, ranking and describing tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from cartflow.plans.ordered import steps_with_previous


def top_values(df: DataFrame, keys: list[str], k: int) -> DataFrame:
    """The ``k`` most frequent key combinations; ties in key order."""
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return counts.orderBy(F.desc("n"), *keys).limit(k)


def share_of_total(df: DataFrame, key: str) -> DataFrame:
    """Rows per key and their percentage of all rows.

    The total is a scalar subquery over the same counts (their shuffle is reused), so no
    window gathers all keys in one task.
    """
    counts = df.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    total = counts.agg(F.sum("n")).scalar()
    return counts.withColumn("percent", F.col("n") * 100.0 / total)


def unique_visitors(df: DataFrame, approximate: bool = False) -> DataFrame:
    """Distinct users; the approximate form keeps a fixed-size sketch per task."""
    count = F.approx_count_distinct if approximate else F.count_distinct
    return df.agg(count("user_id").alias("visitors"))


def daily_unique_visitors(df: DataFrame) -> DataFrame:
    return (df.groupBy(F.to_date("event_time").alias("event_date"))
              .agg(F.count_distinct("user_id").alias("visitors")))


def table_summary(df: DataFrame) -> DataFrame:
    """One row per column: position, name, type, and the table's row count."""
    columns = F.array(*[F.struct(F.lit(i).alias("position"), F.lit(f.name).alias("column_name"),
                                 F.lit(f.dataType.simpleString()).alias("data_type"))
                        for i, f in enumerate(df.schema.fields)])
    return df.agg(F.count(F.lit(1)).alias("row_count")).select(F.inline(columns), "row_count")


def session_journey(df: DataFrame, slices: int | None = None) -> DataFrame:
    """Every event with its step in the session and the type of the event before it."""
    return steps_with_previous(df, ["event_time", "event_id"], ["user_session"], "event_type",
                               previous="previous_type", slices=slices)


def long_form(df: DataFrame, columns: list[str], value: Column | None = None) -> DataFrame:
    """``(column_name, value)`` rows for the given columns, values as text."""
    cells = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value"))
                      for c in columns])
    return df.select(F.inline(cells))


def histogram(df: DataFrame, columns: list[str], bins: int = 10) -> DataFrame:
    """``(column_name, bin, value, n)``: equal-width bins for numbers, counts per value for text.

    Two scans whatever the number of columns: one for the ranges, one for the counts,
    which are combined in the map tasks.
    """
    numeric = [c for c in columns if isinstance(df.schema[c].dataType, NumericType)]
    ranges = df.agg(*[f(F.col(c).cast("double")).alias(f"{c}_{n}") for c in numeric
                      for n, f in (("lo", F.min), ("hi", F.max))]).first() if numeric else None
    cells = []
    for c in columns:
        if c in numeric:
            low, high = ranges[f"{c}_lo"], ranges[f"{c}_hi"]
            if low is None:
                continue
            if low == high:
                low, high = low - 0.5, high + 0.5
            width = (high - low) / bins
            index = F.least(F.floor((F.col(c) - F.lit(low)) / F.lit(width)), F.lit(bins - 1))
            cells.append(F.struct(F.lit(c).alias("column_name"), index.cast("bigint").alias("bin"),
                                  F.lit(None).cast("string").alias("value")))
        else:
            cells.append(F.struct(F.lit(c).alias("column_name"),
                                  F.lit(None).cast("bigint").alias("bin"),
                                  F.col(c).cast("string").alias("value")))
    return (df.select(F.inline(F.array(*cells)))
              .where(F.coalesce(F.col("bin").cast("string"), F.col("value")).isNotNull())
              .groupBy("column_name", "bin", "value").agg(F.count(F.lit(1)).alias("n")))
