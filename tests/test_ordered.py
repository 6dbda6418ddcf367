"""Range-sliced totals against plain windows, with one group holding most rows."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from cartflow.operators.explore import session_journey
from cartflow.plans.lookup import lookup_join
from cartflow.plans.ordered import SLICE, positions, running_totals, slice_by_order, steps_with_previous


@pytest.fixture(scope="module")
def rows(spark):
    group = F.when(F.col("id") % 10 < 7, "hot").when(F.col("id") % 10 == 9, None).otherwise(
        F.concat(F.lit("g"), (F.col("id") % 23).cast("string")))
    return spark.range(3000).select(
        "id", group.alias("g"), ((F.col("id") * 7919) % 101).alias("t"),
        ((F.col("id") * 31) % 17).alias("v")).persist()


@pytest.mark.parametrize("slices", [1, 3, 40])
def test_positions(rows, slices):
    expected = rows.withColumn("position", F.row_number().over(Window.orderBy("t", "id")).cast("bigint"))
    got = positions(rows, ["t", "id"], slices=slices)
    assert got.exceptAll(expected).isEmpty() and got.count() == rows.count()


@pytest.mark.parametrize("slices", [1, 4, 50])
def test_totals_per_group_descending(rows, slices):
    order = [F.desc("t"), "id"]
    window = Window.partitionBy("g").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    expected = rows.withColumn("total", F.sum("v").over(window))
    got = running_totals(rows, order, {"total": F.col("v")}, ["g"], slices)
    assert got.exceptAll(expected).isEmpty() and got.count() == rows.count()


@pytest.mark.parametrize("slices", [1, 5, 60])
def test_steps_and_previous(rows, slices):
    window = Window.partitionBy("g").orderBy("t", "id")
    expected = rows.select("*", F.row_number().over(window).cast("bigint").alias("step"),
                           F.lag("v").over(window).alias("previous"))
    got = steps_with_previous(rows, ["t", "id"], ["g"], "v", slices=slices)
    assert got.exceptAll(expected).isEmpty() and got.count() == rows.count()


def test_a_hot_group_is_spread(rows):
    per_slice = slice_by_order(rows, ["t", "id"], ["g"], 10).groupBy(SLICE).count().collect()
    assert len(per_slice) >= 9 and max(r["count"] for r in per_slice) < 700


def test_empty_table(rows):
    assert positions(rows.limit(0), ["t"]).count() == 0


@pytest.mark.parametrize("limit, join", [(100, "BroadcastHashJoin"), (1, "SortMergeJoin")])
def test_lookup_join_measures_before_broadcasting(spark, rows, limit, join):
    sizes = rows.groupBy("g").count()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = lookup_join(rows, sizes, ["g"], max_rows=limit)
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert join in plan
        assert joined.where("count is not null").count() == rows.where("g is not null").count()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_journey_previous_type(spark):
    df = spark.createDataFrame([(1, 1, "view", "s"), (2, 2, "cart", "s"), (3, 1, "view", "r")],
                               "event_id int, event_time int, event_type string, user_session string")
    rows = {r.event_id: (r.step, r.previous_type) for r in session_journey(df).collect()}
    assert rows == {1: (1, None), 2: (2, "view"), 3: (1, None)}
