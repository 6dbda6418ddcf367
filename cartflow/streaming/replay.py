"""Replaying a stored event table as ordered files, in place of a live producer."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartflow.plans.ordered import positions

ORDER = ["event_time", "event_id"]


def with_chunk(df: DataFrame, rows_per_chunk: int, slices: int | None = None) -> DataFrame:
    """Number chunks of ``rows_per_chunk`` rows in event-time order, from 0."""
    numbered = positions(df, ORDER, "_position", slices=slices)
    return numbered.withColumn("chunk", F.floor((F.col("_position") - 1) / rows_per_chunk)
                               ).drop("_position")


def stage_chunks(df: DataFrame, path: str, rows_per_chunk: int) -> None:
    """Write all chunks at once, one folder each."""
    with_chunk(df, rows_per_chunk).write.partitionBy("chunk").parquet(path)


def publish(staged: DataFrame, target: str, files: int = 1) -> Iterator[int]:
    """Append staged chunks to ``target`` one after the other, ``files`` files each, so files appear in time order.

    The caller sets the pace by iterating. Each append reads only its chunk's folder.
    """
    last = staged.agg(F.max("chunk")).first()[0]
    for chunk in range(0 if last is None else last + 1):
        part = staged.where(F.col("chunk") == chunk).drop("chunk")
        (part.coalesce(1) if files == 1 else part.repartition(files)).write.mode("append").parquet(target)
        yield chunk


def to_payload(df: DataFrame) -> DataFrame:
    """One JSON text per event, keyed by session, as a topic would carry it."""
    stamp = {"timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}
    return df.select(F.col("user_session").alias("key"), F.to_json(F.struct("*"), stamp).alias("value"))
