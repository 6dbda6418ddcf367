"""Helpers shared by the corpus operators."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cartflow.session import work_folder

BLOCK_BYTES = 1 << 20
BLOCK_ROWS = 1000
BATCH_BYTES = 1 << 24
_BATCH_CONF = "spark.sql.execution.arrow.maxBytesPerBatch"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/embeddings.parquet")


def conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/conversations.parquet")


def stored(df: DataFrame, purpose: str, **options: str) -> DataFrame:
    """``df`` written to the shared work folder and read back: computed once, lineage cut."""
    path = work_folder(df.sparkSession, purpose)
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """Queries run inside hand their rows to Python in batches of about ``BATCH_BYTES``, where the session allows more.

    An executor holds a batch up to three times for each task: as vectors, which grow by doubling, and in the worker.
    """
    conf, own = spark.conf, spark.conf.get(_BATCH_CONF, None)
    if own and spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(own) <= BATCH_BYTES:
        yield
        return
    conf.set(_BATCH_CONF, str(BATCH_BYTES))
    try:
        yield
    finally:
        conf.unset(_BATCH_CONF) if own is None else conf.set(_BATCH_CONF, own)


def fresh(df: DataFrame, name: str) -> str:
    """``name``, with underscores added until ``df`` has no such column."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def id_and_text(docs: DataFrame) -> DataFrame:
    """``doc_id`` (long) and ``text`` (null as empty) alone, whatever other columns there are."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))


def fold(doc_id: str | Column, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; null for a null id."""
    key = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.crc32(key.cast("string").cast("binary")) % folds


def blocks(batches: Iterable[pa.RecordBatch], text: str = "text", block_bytes: int = BLOCK_BYTES,
           block_rows: int = BLOCK_ROWS) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """Slices of the batches with their texts as UTF-8 bytes, of about ``block_bytes`` each.

    A block holds whole texts, so one that is longer makes a block of its own.
    """
    for batch in batches:
        texts = batch.column(batch.schema.get_field_index(text)).cast(pa.binary()).to_pylist()
        start = size = 0
        for i, value in enumerate(texts):
            if i > start and (size + len(value) > block_bytes or i - start >= block_rows):
                yield batch.slice(start, i - start), texts[start:i]
                start, size = i, 0
            size += len(value)
        if start < len(texts):
            yield batch.slice(start), texts[start:]
