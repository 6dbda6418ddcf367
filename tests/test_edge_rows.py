"""Rows that the supplied tables do not have: nulls, a larger positive class, date formats, a repeated batch."""

import datetime as dt
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from cartflow import session
from cartflow.catalog import QUERIES
from cartflow.operators import labels, models, sampling
from cartflow.plans.transactions import transaction_table
from cartflow.session import work_folder
from cartflow.sources.collections import Collections
from cartflow.sources.files import read_csv
from cartflow.streaming import sink


def test_the_smaller_class_is_repeated_whichever_it_is(spark):
    rows = spark.createDataFrame([(i, int(i >= 3)) for i in range(10)], "id long, label int")
    out = sampling.oversample_minority(rows, "label").groupBy("label").count().collect()
    assert {r.label: r["count"] for r in out} == {0: 6, 1: 7}


def test_transactions_with_small_numbers_missing_and_no_text(spark):
    rows = [(i, i * 10, i % 2, None if i % 3 == 0 else i % 5) for i in range(40)]
    df = spark.createDataFrame(rows, "transaction_id long, transaction_dt long, is_fraud int, small int")
    df = df.withColumn("small", F.col("small").cast("tinyint"))
    table, names = transaction_table(df, df)
    got = {r.transaction_id: r.small for r in table.collect()}
    assert names == ["small"] and got == {i: -999 if s is None else s for i, _, _, s in rows}


def test_malformed_rows_with_a_date_format(spark):
    path = work_folder(spark, "csv")
    lines = ["day,n", "03/02/2021,1", "2021-02-03,2", "04/02/2021,x", ",5"]
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.text(path)
    rows = read_csv(spark, path, "day date, n int", drop_malformed=True, dateFormat="dd/MM/yyyy").orderBy("n").collect()
    assert [(r.day, r.n) for r in rows] == [(dt.date(2021, 2, 3), 1), (None, 5)]


def test_label_keeps_rows_without_a_session(spark):
    rows = [("s", 1, "cart"), ("s", 1, "purchase"), (None, 1, "cart"), (None, 1, "purchase"), (None, None, "cart")]
    df = spark.createDataFrame(rows, "user_session string, product_id long, event_type string")
    got = labels.label_by_max(df).collect()
    assert sorted((str(r.user_session), str(r.product_id), r.is_purchased) for r in got) == [
        ("None", "1", 1), ("None", "1", 1), ("None", "None", 0), ("s", "1", 1), ("s", "1", 1)]


def test_a_hot_key_of_a_label_join_is_split(spark):
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
                "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
                "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        i = F.col("id")
        df = spark.range(0, 30_000, 1, 8).select(
            F.when(i % 3 == 0, "hot").otherwise(i.cast("string")).alias("user_session"),
            F.when(i % 3 == 0, 1).otherwise(i).alias("product_id"), F.lit("cart").alias("event_type"), (i * 7919).alias("pad"))
        out = labels.label_by_max(df)
        out.write.format("noop").mode("overwrite").save()
        out.collect()
        assert "skew=true" in out._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def _shop(spark, events):
    """A folder with two products and events of (id, seconds, user, type, number)."""
    folder = work_folder(spark, "shop")
    spark.createDataFrame([(k, f"a b{k} c", "Brand#1", "TYPE X", 1, 9.5 + k) for k in range(2)],
                          "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double"
                          ).write.parquet(f"{folder}/part.parquet")
    spark.createDataFrame([(i, dt.datetime(2024, 1, 3) + dt.timedelta(seconds=s), u, k, 1.0, f'{{"k": {n}}}') for i, s, u, k, n in events],
                          "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"
                          ).write.parquet(f"{folder}/events.parquet")
    return folder


def test_the_join_of_raw_rows_writes_every_pair(spark):
    folder = _shop(spark, [(1, 1, 5, "click", 0), (2, 2, 5, "purchase", 0), (3, 3, 5, "purchase", 0), (4, 4, 5, "click", 1),
                           (5, 5, 6, "click", 0), (6, 6, 5, "view", 0)])
    got = QUERIES["c1_label_by_left_join_raw_rows"](spark, folder)
    assert got.columns == ["event_id", "is_purchased"]
    assert sorted(map(tuple, got.collect())) == [(1, 1), (1, 1), (4, 0), (5, 0)]


def test_trees_are_ranked_by_probability(spark):
    rows = spark.createDataFrame([(1.0, [30.0, 10.0], [0.75, 0.25], 0.0), (1.0, [1.0, 4.0], [0.2, 0.8], 1.0)],
                                 "label double, raw array<double>, p array<double>, prediction double")
    from pyspark.ml.functions import array_to_vector

    got = models.scored(rows.select("label", array_to_vector("raw").alias("rawPrediction"),
                                    array_to_vector("p").alias("probability"), "prediction")).collect()
    assert [r.score for r in got] == [0.25, 0.8]


def test_a_repeated_batch_changes_nothing(spark):
    store = Collections(spark, work_folder(spark, "collections"))
    caught = {}
    fake = SimpleNamespace(sparkSession=spark)

    class Writer:
        def foreachBatch(self, save):
            caught["save"] = save
            return self

        def trigger(self, **_):
            return self

        def option(self, *_):
            return self

        def start(self):
            return None

    fake.writeStream = Writer()
    sink.write_collection(fake, store, "shop", "carts")
    for number in (0, 1, 1):
        caught["save"](spark.range(5), number)
    assert store.read("shop", "carts").columns == ["id"] and store.read("shop", "carts").count() == 10


def test_no_machine_local_folder_on_a_cluster():
    context = SimpleNamespace(getCheckpointDir=lambda: None, master="spark://host:7077")
    conf = SimpleNamespace(get=lambda key, default=None: default)
    with pytest.raises(ValueError, match="checkpoint"):
        session.checkpoint_root(SimpleNamespace(sparkContext=context, conf=conf))
