"""Streams. Each reads the event table as a file stream to its end; the final state is compared
with the batch result."""

from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from cartflow.catalog.models import prepared
from cartflow.catalog.registry import query
from cartflow.operators import models as m
from cartflow.session import work_folder
from cartflow.sources import tables as t
from cartflow.sources.collections import Collections
from cartflow.streaming import replay, sink, state, stream

CHUNK_ROWS = 1000
FILES_PER_TRIGGER = 1000


def event_stream(spark, sf):
    """The raw event table as a stream. The braces make the path a pattern, so the table may
    be one file or a folder of files."""
    return stream.file_stream(spark, f"{sf}/{{events}}.parquet", t.table(spark, sf, "events").schema,
                              files_per_trigger=FILES_PER_TRIGGER)


def shop_stream(spark, sf):
    """The same, turned into shop events row by row."""
    return t.shop_events(event_stream(spark, sf), t.table(spark, sf, "part"))


def _run(df, mode="update"):
    path = work_folder(df.sparkSession, "updates")
    sink.finish(sink.write_batches(df, path, mode))
    return path


@query("s1_replay_chunks", t.with_views(f"""
, p AS (SELECT row_number() OVER (ORDER BY event_time, event_id) - 1 AS i FROM behavior)
SELECT CAST(i // {CHUNK_ROWS} AS BIGINT) AS chunk, count(*) AS n FROM p GROUP BY 1""", "behavior"))
def replay_chunks(spark, sf):
    path = work_folder(spark, "replay")
    replay.stage_chunks(t.behavior(spark, sf), path, CHUNK_ROWS)
    return (spark.read.parquet(path).groupBy(F.col("chunk").cast("bigint").alias("chunk"))
            .agg(F.count(F.lit(1)).alias("n")))


@query("s2_stream_source", "SELECT event_id, ts, user_id, event_type, value, props FROM events")
def stream_source(spark, sf):
    return sink.appended(spark, _run(event_stream(spark, sf), "append"))


@query("s3_payload_transformer", t.with_views("""
SELECT event_id, event_time, CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END AS is_purchased,
       CAST(dayofweek(event_time) + 1 AS BIGINT) AS week_day,
       coalesce(string_split(category_code, '.')[1], substring(CAST(category_id AS VARCHAR), 1, 6)) AS category_code_level1_f,
       coalesce(brand, substring(CAST(category_id AS VARCHAR), 1, 6)) AS brand_f, price
FROM behavior""", "behavior"))
def payload_transformer(spark, sf):
    payloads = replay.to_payload(shop_stream(spark, sf))
    items = stream.transform_events(stream.parse_payload(payloads))
    return sink.appended(spark, _run(items.select(
        "event_id", "event_time", "is_purchased", F.col("week_day").cast("bigint").alias("week_day"),
        "category_code_level1_f", "brand_f", "price"), "append"))


@query("s4_sink_to_collection", t.with_views("""
SELECT event_id, event_type, user_session FROM behavior WHERE event_type <> 'view'""", "behavior"))
def sink_to_collection(spark, sf):
    store = Collections(spark, work_folder(spark, "collections"))
    kept = shop_stream(spark, sf).where(F.col("event_type") != "view").select(
        "event_id", "event_type", "user_session")
    sink.finish(sink.write_collection(kept, store, "shop", "targets"))
    return store.read("shop", "targets")


@query("s5_stream_dedup", t.with_views("""
SELECT event_type, product_id, price, user_id, user_session FROM behavior
WHERE event_type IN ('cart', 'purchase') GROUP BY ALL""", "behavior"))
def stream_dedup(spark, sf):
    # A session lasts a week at most, so no copy comes later than eight days.
    kept = stream.dedup_targets(shop_stream(spark, sf), late="8 days")
    return sink.appended(spark, _run(kept.select(*stream.TARGET_KEY), "append"))


@query("s6_session_counts", t.with_views("""
SELECT user_session, count(*) AS activity_count FROM behavior GROUP BY user_session""", "behavior"))
def session_counts(spark, sf):
    path = _run(stream.session_counts(shop_stream(spark, sf)))
    return sink.latest(spark, path, ["user_session"])


_WINDOW = ["window_start", "window_end", "event_type"]


@query("s7_throughput_tumbling", t.with_views("""
SELECT CAST(time_bucket(INTERVAL '5 minutes', event_time) AS TIMESTAMP) AS window_start,
       CAST(time_bucket(INTERVAL '5 minutes', event_time) + INTERVAL 5 MINUTE AS TIMESTAMP) AS window_end,
       event_type, count(*) AS n, round(sum(price), 6) AS price_sum FROM behavior GROUP BY ALL""", "behavior"))
def throughput_tumbling(spark, sf):
    path = _run(stream.throughput(shop_stream(spark, sf)))
    return sink.latest(spark, path, _WINDOW).withColumn("price_sum", F.round("price_sum", 6))


@query("s7_throughput_sliding", t.with_views("""
, s AS (SELECT time_bucket(INTERVAL '1 minute', event_time) - to_minutes(CAST(k AS INT)) AS window_start, event_type, price
        FROM behavior, range(5) r(k))
SELECT CAST(window_start AS TIMESTAMP) AS window_start, CAST(window_start + INTERVAL 5 MINUTE AS TIMESTAMP) AS window_end,
       event_type, count(*) AS n, round(sum(price), 6) AS price_sum FROM s GROUP BY ALL""", "behavior"))
def throughput_sliding(spark, sf):
    path = _run(stream.throughput(shop_stream(spark, sf), slide="1 minute"))
    return sink.latest(spark, path, _WINDOW).withColumn("price_sum", F.round("price_sum", 6))


_QUARTERS, _FILES = 4, 4
# Files of a micro-batch of the replay.
_REPLAY_FILES = 12


@query("s8_late_rows", t.with_views(f"""
, q AS (SELECT event_time, (row_number() OVER (ORDER BY event_time, event_id) - 1)
               // greatest(1, CAST(ceil(count(*) OVER () / {_QUARTERS}.0) AS BIGINT)) AS chunk FROM behavior),
w AS (SELECT epoch_ms(max(event_time)) - 3600000 AS watermark_ms FROM q WHERE chunk = (SELECT max(chunk) FROM q))
SELECT 'dropped' AS outcome, count(*) AS n FROM q, w
WHERE chunk < (SELECT max(chunk) FROM q) - 1 AND epoch_us(event_time) <= watermark_ms * 1000
UNION ALL SELECT 'read', count(*) FROM q""", "behavior"))
def late_rows(spark, sf):
    """All chunks arrive, last first, one a micro-batch. A batch drops the rows behind the watermark that the batch before
    it began with, so the first chunk's watermark is felt from the third chunk on."""
    staged, arrived = work_folder(spark, "replay"), work_folder(spark, "arrived")
    events = t.behavior(spark, sf)
    replay.stage_chunks(events, staged, max(1, -(-events.count() // _QUARTERS)))
    chunks = spark.read.parquet(staged)
    for chunk in sorted((r["chunk"] for r in chunks.select("chunk").distinct().collect()), reverse=True):
        chunks.where(F.col("chunk") == chunk).drop("chunk").repartition(_FILES).write.mode("append").parquet(arrived)
    source = stream.file_stream(spark, arrived, events.schema, files_per_trigger=_FILES)
    # No two rows share an id, so nothing but late rows is left out, and each is counted by itself.
    once = stream.zoned(source).withWatermark("event_time", "1 hour").dropDuplicatesWithinWatermark(["event_id"])
    with sink.progress_totals(spark) as listener:
        running = sink.finish(sink.write_batches(once, work_folder(spark, "updates"), "append"))
        found = sink.totals_of(listener, running)
    return spark.createDataFrame([("dropped", found["dropped_rows"]), ("read", found["input_rows"])], "outcome string, n bigint")


@query("s9_running_labels", t.with_views("""
SELECT user_session, product_id, max(CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END) AS is_purchased
FROM behavior WHERE event_type IN ('cart', 'purchase') GROUP BY user_session, product_id""", "behavior"))
def running_labels(spark, sf):
    path = _run(stream.running_labels(shop_stream(spark, sf)))
    return sink.latest(spark, path, stream.ITEM)


def replayed(spark, sf, batches=6):
    """The shop events in time order, as files that are read a few at a time: several micro-batches, each of many tasks."""
    staged, arrived = work_folder(spark, "replay"), work_folder(spark, "arrived")
    events = t.behavior(spark, sf)
    replay.stage_chunks(events, staged, max(1, -(-events.count() // batches)))
    for _ in replay.publish(spark.read.parquet(staged), arrived, _REPLAY_FILES):
        pass
    return stream.zoned(stream.file_stream(spark, arrived, events.schema, files_per_trigger=_REPLAY_FILES))


@query("s6_session_counts_with_life_time", t.with_views("""
SELECT user_session, count(*) AS activity_count FROM behavior GROUP BY user_session""", "behavior"))
def session_counts_with_life_time(spark, sf):
    path = _run(state.session_counts(replayed(spark, sf)), "append")
    return spark.read.parquet(path).groupBy("user_session").agg(F.max("activity_count").alias("activity_count"))


@query("s9_running_labels_with_life_time", t.with_views("""
SELECT user_session, product_id, CAST(max(CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END) AS INTEGER) AS is_purchased
FROM behavior WHERE event_type IN ('cart', 'purchase') GROUP BY user_session, product_id""", "behavior"))
def running_labels_with_life_time(spark, sf):
    return sink.latest(spark, _run(state.running_labels(replayed(spark, sf)), "append"), stream.ITEM)


@query("s10_running_activity", t.with_views("""
, n AS (SELECT *, row_number() OVER (PARTITION BY user_session ORDER BY event_time, event_id) AS activity_count FROM behavior)
SELECT event_id, user_session, product_id, activity_count FROM n WHERE event_type = 'cart'""", "behavior"))
def running_activity(spark, sf):
    counted = state.running_counts(replayed(spark, sf)).where(F.col("event_type") == "cart")
    return sink.appended(spark, _run(counted.select("event_id", "user_session", "product_id", "activity_count"), "append"))


@query("s10_score_stream")
def score_stream(spark, sf):
    data, path = prepared(spark, sf), work_folder(spark, "model")
    m.save_model(PipelineModel([*data.features.stages, m.estimator("LR").fit(data.train)]), path)
    data.release()
    # The count that the model asks for is kept by the same stream: no cart sees an event after it.
    events = replayed(spark, sf)
    counted = state.running_counts(events).where(F.col("event_type") == "cart")
    products = t.products(t.table(spark, sf, "part"))
    carts = stream.transform_events(counted.join(products, "product_id"))
    scored = stream.score_stream(carts, PipelineModel.load(path))
    return sink.appended(spark, _run(scored.select("event_id", "user_session", "product_id", "activity_count", "prediction"), "append"))
