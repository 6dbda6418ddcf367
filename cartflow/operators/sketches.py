"""Distinct counts over any range of days, from one stored sketch a day.

A HyperLogLog sketch of a day has a fixed size and two of them merge into the sketch of both days, so the events are read
once, when their day is loaded, and every later question reads a few kilobytes a day.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

LG_BUCKETS = 12
# Relative standard error of a merged sketch of 2^12 buckets is 1.04 / 64; three of them.
ERROR = 3 * 1.04 / 2 ** (LG_BUCKETS / 2)


def daily_sketches(df: DataFrame, item: str = "user_id", time: str = "event_time", lg_buckets: int = LG_BUCKETS) -> DataFrame:
    """``(day, sketch)``; tasks send one sketch a day. Rows without a time are left out, null items do not count."""
    timed = df.where(F.col(time).isNotNull())
    return timed.groupBy(F.to_date(time).alias("day")).agg(F.hll_sketch_agg(item, lg_buckets).alias("sketch"))


def save_days(sketches: DataFrame, path: str) -> None:
    """Store by day. A day that is loaded again replaces its sketch, the others stay."""
    (sketches.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("day").parquet(path))


def stored_days(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("sketch binary, day date").parquet(path)


def distinct_over(sketches: DataFrame, ranges: DataFrame) -> DataFrame:
    """``ranges`` (first_day, last_day) with ``visitors``, estimated from the sketches of their days; 0 where none is stored.

    A range that stands in several rows is returned once; one with a null end holds no day.
    """
    days = ranges.distinct().select("*", F.explode_outer(F.when(
        F.col("first_day") <= F.col("last_day"), F.sequence("first_day", "last_day"))).alias("day"))
    merged = days.join(sketches, "day", "left").groupBy("first_day", "last_day").agg(F.hll_union_agg("sketch").alias("s"))
    return merged.select("first_day", "last_day", F.coalesce(F.hll_sketch_estimate("s"), F.lit(0)).alias("visitors"))


def days_up_to(days: DataFrame, length: int) -> DataFrame:
    """The range of ``length`` days that ends at each ``day``."""
    return days.select(F.date_sub("day", length - 1).alias("first_day"), F.col("day").alias("last_day")).distinct()
