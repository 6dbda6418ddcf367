"""Running a stream to files or collections, and reading the result back."""

from __future__ import annotations

import time
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from cartflow.session import work_folder
from cartflow.sources.collections import BATCH

STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


@contextmanager
def _state_on_disk(spark: SparkSession):
    """Keep state in RocksDB for queries started inside, so it may outgrow the heap."""
    previous = spark.conf.get(STATE_STORE)
    spark.conf.set(STATE_STORE, ROCKSDB)
    try:
        yield
    finally:
        spark.conf.set(STATE_STORE, previous)


def write_batches(df: DataFrame, path: str, mode: str = "update", checkpoint: str | None = None,
                  available_now: bool = True) -> StreamingQuery:
    """Write every micro-batch to its own ``batch=N`` folder.

    A batch repeated after a failure replaces its folder, so each one counts once.
    """
    spark = df.sparkSession

    def save(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={number}")

    writer = (df.writeStream.outputMode(mode).foreachBatch(save)
              .option("checkpointLocation", checkpoint or work_folder(spark, "stream")))
    if available_now:
        writer = writer.trigger(availableNow=True)
    with _state_on_disk(spark):
        return writer.start()


def write_collection(df: DataFrame, collections, database: str, name: str,
                     checkpoint: str | None = None) -> StreamingQuery:
    """Write every micro-batch to a named collection, one commit a batch.

    In files a batch has a folder of its own, which a repetition after a failure replaces;
    a document store appends, so there a repeated batch counts again.
    """
    def save(batch: DataFrame, number: int) -> None:
        if collections.root is None:
            collections.write(batch, database, name, mode="append")
        else:
            collections.write(batch, database, f"{name}/{BATCH}={number}", mode="overwrite")

    writer = (df.writeStream.foreachBatch(save).trigger(availableNow=True)
              .option("checkpointLocation", checkpoint or work_folder(df.sparkSession, "stream")))
    with _state_on_disk(df.sparkSession):
        return writer.start()


def finish(query: StreamingQuery) -> StreamingQuery:
    query.awaitTermination()
    return query


def appended(spark: SparkSession, path: str) -> DataFrame:
    """All rows of all batches."""
    return spark.read.parquet(path).drop("batch")


def latest(spark: SparkSession, path: str, keys: list[str]) -> DataFrame:
    """The newest update of each key."""
    updates = spark.read.parquet(path)
    values = [c for c in updates.columns if c not in (*keys, "batch")]
    newest = updates.groupBy(*keys).agg(F.max_by(F.struct(*values), "batch").alias("_v"))
    return newest.select(*keys, *[F.col(f"_v.{c}").alias(c) for c in values])


class ProgressTotals(StreamingQueryListener):
    """Adds up what the progress reports of all micro-batches say, however many there are.

    ``totals[query id]`` has batches, input_rows, dropped_rows (by the watermark, counted where a stateful operator drops
    them), and state_rows, the state's rows after the last batch.
    """

    def __init__(self):
        self.totals: dict[str, dict[str, int]] = {}

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        total = self.totals.setdefault(str(progress.id), dict.fromkeys(("batches", "input_rows", "dropped_rows", "state_rows"), 0))
        total["batches"] += 1
        total["input_rows"] += progress.numInputRows
        total["dropped_rows"] += sum(s.numRowsDroppedByWatermark for s in progress.stateOperators)
        total["state_rows"] = sum(s.numRowsTotal for s in progress.stateOperators)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self.totals.setdefault(str(event.id), {})["ended"] = 1


@contextmanager
def progress_totals(spark: SparkSession):
    """A ``ProgressTotals`` that listens to queries inside."""
    listener = ProgressTotals()
    spark.streams.addListener(listener)
    try:
        yield listener
    finally:
        spark.streams.removeListener(listener)


def totals_of(listener: ProgressTotals, query: StreamingQuery, patience: float = 30.0) -> dict[str, int]:
    """The totals of an ended query. Reports come a little later than the batches, so the end is waited for."""
    until = time.monotonic() + patience
    while "ended" not in listener.totals.get(str(query.id), {}) and time.monotonic() < until:
        time.sleep(0.05)
    found = {"batches": 0, "input_rows": 0, "dropped_rows": 0, "state_rows": 0, **listener.totals.get(str(query.id), {})}
    if "ended" not in found:
        raise TimeoutError("the query's end was not reported")
    return found
