"""The split join and the bitmap filter: same rows as a plain join, and plans that bear a third of the rows in one key."""

import pytest
from pyspark.sql import functions as F

from cartflow.operators.labels import with_activity
from cartflow.plans.bitmap import may_match
from cartflow.plans.heavy import KEYS, heavy_keys, split_join
from cartflow.session import materialise


@pytest.fixture(scope="module")
def facts(spark):
    hot = F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 100 == 1, None).otherwise((F.col("id") % 9000).cast("string"))
    return materialise(spark.range(60_000).select("id", hot.alias("k")).repartition(6))


@pytest.fixture(scope="module")
def lookup(spark, facts):
    return materialise(facts.where("id % 5 > 0").dropna().groupBy("k").agg(F.count("*").alias("n")))


def test_only_heavy_keys_are_named(facts):
    assert [r["k"] for r in heavy_keys(facts, ["k"]).collect()] == ["hot"]


@pytest.mark.parametrize("how", ["left", "inner"])
def test_same_rows_as_a_plain_join(facts, lookup, how):
    got, expected = split_join(facts, lookup, ["k"], how), facts.join(lookup, "k", how)
    assert got.exceptAll(expected).isEmpty() and got.count() == expected.count()


def test_no_task_reads_much_more_than_another(spark, facts, lookup):
    """Without broadcast by size: the hot key is joined where it lies, the others are dealt evenly."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "12")
    try:
        joined = split_join(facts, lookup, ["k"], "inner")
        counts = [r["count"] for r in joined.where("k != 'hot'").groupBy(F.spark_partition_id()).count().collect()]
        plan = joined._jdf.queryExecution().executedPlan().toString()
    finally:
        for key in ("autoBroadcastJoinThreshold", "adaptive.coalescePartitions.enabled"):
            spark.conf.unset(f"spark.sql.{key}")
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert max(counts) < 2 * sorted(counts)[len(counts) // 2]
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" in plan


def test_a_table_without_heavy_keys_and_an_empty_one(spark, lookup):
    even = spark.range(3 * KEYS).select(F.col("id").cast("string").alias("k"))
    assert heavy_keys(even, ["k"]).isEmpty()
    assert split_join(even, lookup, ["k"]).count() == 3 * KEYS
    assert split_join(even.limit(0), lookup, ["k"]).isEmpty()


def test_activity_of_a_hot_session(spark, facts):
    rows = facts.withColumnRenamed("k", "user_session")
    counts = rows.dropna().groupBy("user_session").agg(F.count("*").alias("activity_count"))
    one, two = (with_activity(rows, counts, split=s) for s in (True, False))
    assert one.exceptAll(two).isEmpty() and one.count() == two.count() == 60_000


def test_bitmap_lets_all_matches_through_and_few_others(spark):
    members = spark.range(0, 200_000, 7).withColumnRenamed("id", "m")
    rows = spark.range(200_000).withColumn("k", F.when(F.col("id") % 50 != 3, F.col("id")))
    passed = may_match(rows, "k", members, "m")
    assert passed.columns == rows.columns
    hits = rows.where("k % 7 = 0").count()
    assert passed.where("k % 7 = 0").count() == hits
    # 28,572 keys in 2^26 bits: one in 2,300 of the others passes.
    assert hits <= passed.count() <= hits + 400
    assert may_match(rows, "k", members.limit(0), "m").isEmpty()
