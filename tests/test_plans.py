"""Plan shapes that decide whether a query survives large inputs."""

import re

import pytest
from pyspark.sql import functions as F

from cartflow.catalog import QUERIES
from cartflow.operators.dedup import TARGET_KEY, keep_first
from cartflow.operators.labels import targets
from cartflow.plans.training import FIRST, training_table
from cartflow.session import work_folder
from cartflow.sources.tables import behavior


@pytest.fixture(scope="module")
def stored(spark, sf_dir):
    path = work_folder(spark, "events")
    behavior(spark, sf_dir).write.parquet(path)
    return spark.read.parquet(path)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_filters_and_columns_reach_the_scan(stored):
    text = plan(targets(stored).groupBy("user_session").count())
    assert "PushedFilters: [In(event_type, [cart,purchase])]" in text
    assert "ReadSchema: struct<event_type:string,user_session:string>" in text


def test_keep_first_reduces_before_the_shuffle(stored):
    text = plan(keep_first(targets(stored), TARGET_KEY, FIRST))
    assert re.search(r"WindowGroupLimit.*Final[\s\S]*Exchange[\s\S]*WindowGroupLimit.*Partial", text)


def test_training_table_shuffles(spark, stored):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(training_table(stored))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert text.count("Exchange hashpartitioning") <= 7
    assert "Python" not in text and "SinglePartition" not in text
    assert "CartesianProduct" not in text and "NestedLoop" not in text


def test_top_k_does_not_sort_everything(spark, sf_dir):
    assert "TakeOrderedAndProject" in plan(QUERIES["d3_brand_top_sellers"](spark, sf_dir))


@pytest.mark.parametrize("name", ["e4_session_journey", "t5_contiguous_folds", "v5_roc_points", "p1_index_by_frequency",
                                  "w1_counter_rate", "t1_exact_sample_per_class", "w5_exact_quantiles", "s1_replay_chunks"])
def test_no_window_over_the_whole_table(spark, sf_dir, name):
    text = plan(QUERIES[name](spark, sf_dir))
    assert not re.search(r"Window .*\], \[\], ", text)
    assert "CartesianProduct" not in text and "NestedLoopJoin" not in text


def test_no_python_in_any_batch_plan(spark, sf_dir):
    for name in ("p10_training_table", "b19_b20_identity_split", "d12_d14_column_profile", "d15_histogram"):
        assert "Python" not in plan(QUERIES[name](spark, sf_dir)), name


def test_one_hot_session_is_counted_right(spark):
    """A third of all rows in one session, one product, one price."""
    rows = spark.range(30000).select(
        F.col("id").alias("event_id"), F.timestamp_seconds(F.col("id")).cast("timestamp_ntz").alias("event_time"),
        F.when(F.col("id") % 2 == 0, "cart").otherwise("view").alias("event_type"),
        F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id")).alias("product_id"),
        F.lit(2000000000000000777).alias("category_id"), F.lit("a.b").alias("category_code"), F.lit("x").alias("brand"),
        F.lit(1.0).alias("price"), F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id")).alias("user_id"),
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("user_session"))
    table = training_table(rows)
    assert table.count() == 1 + 10000
    assert table.agg(F.max("activity_count")).first()[0] == 10000
