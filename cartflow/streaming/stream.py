"""Streams of shop events: sources, row-wise transformation, running aggregates.

Windows and watermarks need a zoned timestamp, so ``event_time`` is cast on the way in
(the session runs in UTC). The same batch functions serve streams wherever no state is
involved.
"""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from cartflow.operators.dedup import TARGET_KEY
from cartflow.operators.labels import ITEM, add_is_purchased, targets
from cartflow.plans.training import add_item_columns
from cartflow.schemas import EVENTS_WITH_ID


def file_stream(spark: SparkSession, path: str, schema: StructType, fmt: str = "parquet",
                files_per_trigger: int | None = None) -> DataFrame:
    """Files appearing in a folder; ``files_per_trigger`` bounds a micro-batch."""
    reader = spark.readStream.schema(schema).format(fmt)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.load(path)


def topic_stream(spark: SparkSession, servers: str, topic: str = "default_topic",
                 **options: str) -> DataFrame:
    """A Kafka topic's messages as ``(key, value)`` text; needs the connector on the class path."""
    raw = (spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers)
           .option("subscribe", topic).options(**options).load())
    return raw.select(F.col("key").cast("string"), F.col("value").cast("string"))


def publish_to_topic(df: DataFrame, servers: str, topic: str = "default_topic") -> None:
    """Send ``(key, value)`` rows to a Kafka topic; needs the connector on the class path."""
    (df.write.format("kafka").option("kafka.bootstrap.servers", servers)
       .option("topic", topic).save())


def parse_payload(df: DataFrame, schema: StructType = EVENTS_WITH_ID) -> DataFrame:
    """Event columns from JSON payloads; a broken payload gives a row of nulls and is dropped."""
    parsed = df.select(F.from_json("value", schema).alias("e")).select("e.*")
    return parsed.where(F.col("event_type").isNotNull())


def transform_events(df: DataFrame) -> DataFrame:
    """Label flag, time parts, category levels, id parts and fallbacks for each event."""
    return df.transform(add_is_purchased).transform(add_item_columns)


def zoned(df: DataFrame) -> DataFrame:
    return df.withColumn("event_time", F.col("event_time").cast("timestamp"))


def dedup_targets(df: DataFrame, late: str = "1 hour") -> DataFrame:
    """First-seen cart or purchase row of each five-column key.

    State is dropped once the watermark passes, so a copy arriving more than ``late``
    after the first one is kept. Micro-batch limits of the source bound what one task gets.
    """
    return (targets(zoned(df)).withWatermark("event_time", late)
            .dropDuplicatesWithinWatermark(TARGET_KEY))


def session_counts(df: DataFrame) -> DataFrame:
    """Running number of events per session (update mode)."""
    return df.groupBy("user_session").agg(F.count(F.lit(1)).alias("activity_count"))


def throughput(df: DataFrame, window: str = "5 minutes", slide: str | None = None,
               late: str | None = None) -> DataFrame:
    """Events and turnover per type in tumbling or sliding windows of event time."""
    events = zoned(df)
    if late:
        events = events.withWatermark("event_time", late)
    frame = F.window("event_time", window, slide) if slide else F.window("event_time", window)
    return events.groupBy(frame.alias("w"), "event_type").agg(
        F.count(F.lit(1)).alias("n"), F.sum("price").alias("price_sum")
    ).select(F.col("w.start").cast("timestamp_ntz").alias("window_start"),
             F.col("w.end").cast("timestamp_ntz").alias("window_end"), "event_type", "n", "price_sum")


def running_labels(df: DataFrame) -> DataFrame:
    """Latest purchase label of each (session, product) (update mode)."""
    return (add_is_purchased(targets(df)).groupBy(*ITEM)
            .agg(F.max("is_purchased").alias("is_purchased")))


def score_stream(df: DataFrame, model: PipelineModel) -> DataFrame:
    """Apply a fitted model to a stream; every stage is row-wise by then."""
    return model.transform(df)
