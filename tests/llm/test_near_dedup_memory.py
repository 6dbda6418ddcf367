"""What op1 holds at once does not grow with the rows of a task."""

import numpy as np
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from cartflow.llm import common
from cartflow.llm import shingle_idf as s

_NAME = "spark.sql.execution.arrow.maxBytesPerBatch"


def test_a_row_group_of_blocks_is_small_however_well_it_compresses(spark):
    """One task with 10 blocks of 2 MB, all of one word."""
    docs = spark.range(10, numPartitions=1).select(
        F.col("id").alias("doc_id"), F.lit(b"n").alias("node"), F.col("id").alias("row"),
        F.repeat(F.concat(F.lit("w"), F.col("id"), F.lit(" ")), 700_000).alias("text"))
    packed = s.packed_texts(docs)
    groups = []
    for file in packed.inputFiles():
        found = pq.ParquetFile(file.removeprefix("file://")).metadata
        groups += [found.row_group(i).num_rows for i in range(found.num_row_groups)]
    assert sum(groups) == packed.count() == 10 and max(groups) <= s.BLOCKS_OF_ROW_GROUP
    assert packed.agg(F.sum("bytes"), F.sum("worded")).first()[:] == (10 * 700_000 * 3, 10)


@pytest.mark.parametrize("own, inside", [(None, common.BATCH_BYTES), ("200m", common.BATCH_BYTES), ("1m", 1 << 20)])
def test_batches_are_small_inside_only(spark, own, inside):
    before = spark.conf.get(_NAME, None)
    try:
        spark.conf.unset(_NAME) if own is None else spark.conf.set(_NAME, own)
        outside = spark.conf.get(_NAME, None)
        with pytest.raises(ZeroDivisionError), common.small_batches(spark):
            assert spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get(_NAME)) == inside
            raise ZeroDivisionError
        assert spark.conf.get(_NAME, None) == outside
    finally:
        spark.conf.unset(_NAME) if before is None else spark.conf.set(_NAME, before)


def test_totals_by_hash():
    h, here = np.array([7, 3, 7, 3, 9], np.uint64), np.array([1, 2, 3, 0xFFFFFFFF, 5], np.uint32)
    assert s._totals(h, here).tolist() == [4, 0xFFFFFFFF, 4, 0xFFFFFFFF, 5]
