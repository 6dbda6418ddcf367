"""Collections, files, replay order, late rows, payloads, repeated batches."""

import datetime as dt

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from cartflow.schemas import EVENTS, EVENTS_WITH_ID
from cartflow.session import checkpoint_root, work_folder
from cartflow.sources.collections import Collections
from cartflow.sources.files import read_csv, read_extended_json, write_csv, write_events
from cartflow.sources.tables import behavior
from cartflow.streaming import replay, sink, state, stream


@pytest.fixture(scope="module")
def shop(spark, sf_dir):
    return behavior(spark, sf_dir).persist()


def test_checkpoint_root_is_kept(spark):
    assert checkpoint_root(spark) == checkpoint_root(spark)
    assert work_folder(spark, "x") != work_folder(spark, "x")


def test_collection_modes(spark):
    store = Collections(spark, work_folder(spark, "collections"))
    df = spark.range(3)
    assert store.is_empty("d", "c")
    assert store.load_once(df, "d", "c") and not store.load_once(df, "d", "c")
    store.write(df, "d", "c", mode="append")
    assert store.read("d", "c").count() == 6
    store.write(df, "d", "c", mode="overwrite")
    assert store.read("d", "c").count() == 3
    with pytest.raises(AnalysisException, match="already exists"):
        store.write(df, "d", "c")


def test_earliest_document(spark):
    store = Collections(spark, work_folder(spark, "collections"), fmt="json")
    rows = [(1, "b", 2), (1, "a", 1), (2, "c", 5)]
    store.write(spark.createDataFrame(rows, "myid int, doc string, t int"), "d", "times")
    got = store.read_earliest("d", "times", ["myid"], ["t"], "myid int, doc string, t int").collect()
    assert sorted((r.myid, r.doc) for r in got) == [(1, "a"), (2, "c")]


def test_extended_json(spark):
    path = work_folder(spark, "documents")
    lines = ['{"_id":{"$oid":"00aa"},"doc":"K ","timestamp":{"$date":"2021-03-04T05:06:07.575Z"},"myid":3.0}',
             '{"_id":{"$oid":"00bb"},"doc":"Q ","timestamp":{"$date":"2020-12-11T10:09:08.125Z"},"myid":1.0}']
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.text(path)
    rows = read_extended_json(spark, path).orderBy("myid").collect()
    assert [(r.doc, r.myid) for r in rows] == [("Q ", 1.0), ("K ", 3.0)]
    assert rows[1].timestamp.microsecond == 575000


def test_malformed_rows_are_dropped_even_if_the_column_is_not_read(spark):
    path = work_folder(spark, "csv")
    spark.createDataFrame([("a,b",), ("1,2",), ("x,3",), ("6",), ("7,8,9",), ("4,5",), (",1",)], "value string").coalesce(1).write.text(path)
    assert read_csv(spark, path, "a int, b int", drop_malformed=True).select("b").count() == 3


def test_csv_of_the_shop_export(spark):
    path = work_folder(spark, "csv")
    text = ["event_time,event_type,product_id,category_id,category_code,brand,price,user_id,user_session",
            "2022-06-07 00:00:00 UTC,view,12,2000000000000000012,,acme,10.50,34,s-34"]
    spark.createDataFrame([(x,) for x in text], "value string").coalesce(1).write.text(path)
    row = read_csv(spark, path, timestampNTZFormat="yyyy-MM-dd HH:mm:ss 'UTC'").first()
    assert (row.event_time, row.category_code, row.price) == (dt.datetime(2022, 6, 7), None, 10.5)


def test_csv_round_trip(spark, shop):
    path = work_folder(spark, "csv")
    nine = shop.select(EVENTS.fieldNames())
    write_csv(nine, path)
    assert read_csv(spark, path).exceptAll(nine).isEmpty()


def test_event_store_prunes_by_day(spark, shop):
    path = work_folder(spark, "events")
    write_events(shop, path)
    day = spark.read.parquet(path).where(F.col("event_date") == "2024-01-03").where("event_type = 'cart'")
    plan = day._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(event_date" in plan and "EqualTo(event_type,cart)" in plan
    assert day.count() == shop.where("to_date(event_time) = '2024-01-03' and event_type = 'cart'").count()


def _published(spark, shop, rows_per_chunk):
    staged, target = work_folder(spark, "staged"), work_folder(spark, "topic")
    replay.stage_chunks(shop, staged, rows_per_chunk)
    return spark.read.parquet(staged), target


def test_replay_then_running_counts_in_several_batches(spark, shop):
    staged, target = _published(spark, shop, 300)
    assert list(replay.publish(staged, target)) == [0, 1, 2, 3]
    source = stream.file_stream(spark, target, EVENTS_WITH_ID, files_per_trigger=1)
    path = work_folder(spark, "updates")
    query = sink.finish(sink.write_batches(stream.session_counts(source), path))
    assert sum(p.numInputRows for p in query.recentProgress) == shop.count()
    got = sink.latest(spark, path, ["user_session"])
    expected = shop.groupBy("user_session").agg(F.count("*").alias("activity_count"))
    assert got.exceptAll(expected).isEmpty() and got.count() == expected.count()


def test_windows_in_time_order_lose_nothing_and_unordered_are_late(spark, shop):
    staged, ordered = _published(spark, shop, 300)
    assert len(list(replay.publish(staged, ordered))) == 4
    backwards = work_folder(spark, "topic")
    for chunk in (3, 2, 1, 0):
        staged.where(F.col("chunk") == chunk).drop("chunk").coalesce(1).write.mode("append").parquet(backwards)
    dropped = []
    for folder in (ordered, backwards):
        source = stream.file_stream(spark, folder, EVENTS_WITH_ID, files_per_trigger=1)
        with sink.progress_totals(spark) as listener:
            query = sink.finish(sink.write_batches(stream.throughput(source, late="1 hour"), work_folder(spark, "u")))
            dropped.append(sink.totals_of(listener, query)["dropped_rows"])
    assert dropped[0] == 0 and dropped[1] > 0


def test_totals_cover_more_batches_than_the_reports_that_are_kept(spark):
    folder = work_folder(spark, "many")
    for i in range(7):
        spark.range(i * 10, i * 10 + 5, 1, 1).write.mode("append").parquet(folder)
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", "2")
    try:
        source = stream.file_stream(spark, folder, spark.range(1).schema, files_per_trigger=1)
        with sink.progress_totals(spark) as listener:
            query = sink.finish(sink.write_batches(source, work_folder(spark, "u"), "append"))
            found = sink.totals_of(listener, query)
    finally:
        spark.conf.unset("spark.sql.streaming.numRecentProgressUpdates")
    assert len(query.recentProgress) <= 2 and (found["batches"], found["input_rows"]) == (7, 35)


def _days(spark, rows):
    """(id, day, session, product, type) as events, one file a day, in order."""
    folder = work_folder(spark, "days")
    schema = "event_id long, day int, user_session string, product_id long, event_type string"
    for day in sorted({r[1] for r in rows}):
        spark.createDataFrame([r for r in rows if r[1] == day], schema).select(
            "event_id", F.timestamp_seconds((F.col("day") + 19_000) * 86400).alias("event_time"), "user_session", "product_id", "event_type",
        ).coalesce(1).write.mode("append").parquet(folder)
    return stream.file_stream(spark, folder, spark.read.parquet(folder).schema, files_per_trigger=1)


def test_state_goes_after_its_life_time_and_counts_are_right(spark):
    rows = [(i, day, f"s{day // 4}", 1, "view") for i, day in enumerate(d for d in range(16) for _ in range(3))]
    with sink.progress_totals(spark) as listener:
        path = work_folder(spark, "counts")
        query = sink.finish(sink.write_batches(state.running_counts(_days(spark, rows), life="3 days"), path, "append"))
        found = sink.totals_of(listener, query)
    got = {r["event_id"]: r["activity_count"] for r in spark.read.parquet(path).collect()}
    seen: dict = {}
    for i, _, session, *_ in rows:
        seen[session] = seen.get(session, 0) + 1
        assert got[i] == seen[session]
    assert found["batches"] >= 16 and found["dropped_rows"] == 0
    # Four sessions came; those of the last days alone are still held (a value and a timer each, and their index).
    assert 0 < found["state_rows"] <= 4 * 3


def test_state_calls_are_made_a_bucket_and_not_a_key(spark):
    rows = [(i, day, f"s{i % 400}" if i % 7 else None, 1, "view") for i, day in enumerate(d for d in range(2) for _ in range(800))]
    with sink.progress_totals(spark) as listener:
        path = work_folder(spark, "counts")
        query = sink.finish(sink.write_batches(state.running_counts(_days(spark, rows), life="3 days", buckets=8), path, "append"))
        found = sink.totals_of(listener, query)
    seen: dict = {}
    got = {r["event_id"]: (r["user_session"], r["activity_count"]) for r in spark.read.parquet(path).collect()}
    for i, _, session, *_ in rows:
        seen[session] = seen.get(session, 0) + 1
        assert got[i] == (session, seen[session])
    # A value, and a timer with its index, for each bucket.
    assert 0 < found["state_rows"] <= 8 * 3


def test_a_key_starts_again_after_its_life_time(spark):
    rows = [(1, 0, "a", 7, "purchase"), (2, 1, "a", 7, "cart"), (3, 20, "b", 1, "cart"), (4, 21, "b", 1, "cart"), (5, 30, "a", 7, "cart")]
    path = work_folder(spark, "labels")
    sink.finish(sink.write_batches(state.running_labels(_days(spark, rows), life="3 days"), path, "append"))
    found = sorted((r["batch"], r["user_session"], r["is_purchased"]) for r in spark.read.parquet(path).collect())
    assert [f[1:] for f in found] == [("a", 1), ("a", 1), ("b", 0), ("b", 0), ("a", 0)]


def test_dedup_across_batches(spark, shop):
    staged, target = _published(spark, shop, 300)
    list(replay.publish(staged, target))
    source = stream.file_stream(spark, target, EVENTS_WITH_ID, files_per_trigger=1)
    path = work_folder(spark, "updates")
    sink.finish(sink.write_batches(stream.dedup_targets(source, "8 days"), path, "append"))
    expected = shop.where("event_type in ('cart', 'purchase')").dropDuplicates(stream.TARGET_KEY).count()
    assert sink.appended(spark, path).count() == expected


def test_payload_round_trip_and_broken_payload(spark, shop):
    broken = spark.createDataFrame([("k", "{not json")], "key string, value string")
    back = stream.parse_payload(replay.to_payload(shop).unionByName(broken))
    assert back.exceptAll(shop).isEmpty() and back.count() == shop.count()


def test_a_repeated_batch_counts_once(spark):
    path = work_folder(spark, "updates")
    for _ in range(2):
        spark.range(5).write.mode("overwrite").parquet(f"{path}/batch=0")
    assert sink.appended(spark, path).count() == 5


def test_stream_to_collection(spark, shop):
    staged, target = _published(spark, shop, 500)
    list(replay.publish(staged, target))
    store = Collections(spark, work_folder(spark, "collections"))
    source = stream.file_stream(spark, target, EVENTS_WITH_ID, files_per_trigger=1)
    sink.finish(sink.write_collection(source.where("event_type = 'cart'"), store, "shop", "carts"))
    assert store.read("shop", "carts").count() == shop.where("event_type = 'cart'").count()
