"""Monitoring aggregates."""

from pyspark.sql import functions as F

from cartflow.catalog.registry import query
from cartflow.operators import monitoring as m
from cartflow.sources import tables as t

RATE = """
, l AS (SELECT *, lag(value) OVER (PARTITION BY metric, topic, instance ORDER BY ts) AS before FROM metric_samples),
i AS (SELECT *, CASE WHEN before IS NULL THEN 0 WHEN value < before THEN value ELSE value - before END AS increase FROM l),
w AS (SELECT ts, metric, topic, instance, value,
             sum(increase) OVER (PARTITION BY metric, topic, instance ORDER BY ts
                                 RANGE BETWEEN INTERVAL {seconds} SECOND PRECEDING AND CURRENT ROW) / {seconds} AS rate
      FROM i)"""


@query("w1_counter_rate", t.with_views(RATE.format(seconds=300) + """
SELECT ts, metric, topic, instance, value, round(rate, 6) AS rate FROM w""", "metric_samples"))
def counter_rate(spark, sf):
    return m.counter_rate(t.metric_samples(spark, sf)).withColumn("rate", F.round("rate", 6))


@query("w1_counter_rate_one_minute", t.with_views(RATE.format(seconds=60) + """
SELECT ts, topic, instance, round(rate, 6) AS rate FROM w""", "metric_samples"))
def counter_rate_one_minute(spark, sf):
    return m.counter_rate(t.metric_samples(spark, sf), window_seconds=60).select(
        "ts", "topic", "instance", F.round("rate", 6).alias("rate"))


@query("w2_sum_without_instance", t.with_views("""
, s AS (SELECT date_trunc('minute', ts) AS minute, metric, topic, instance, arg_max(value, ts) AS value
        FROM metric_samples WHERE topic <> '' GROUP BY ALL)
SELECT CAST(minute AS TIMESTAMP) AS ts, metric, topic, sum(value) AS value FROM s GROUP BY minute, metric, topic""", "metric_samples"))
def sum_without_instance(spark, sf):
    return m.sum_without(t.metric_samples(spark, sf), "value", ["instance"])


@query("w3_topic_rates", t.with_views(RATE.format(seconds=300) + """
, s AS (SELECT date_trunc('minute', ts) AS minute, metric, topic, instance, arg_max(rate, ts) AS rate
        FROM w WHERE topic <> '' GROUP BY ALL)
SELECT CAST(minute AS TIMESTAMP) AS ts, metric, topic, round(sum(rate), 6) AS rate
FROM s GROUP BY minute, metric, topic""", "metric_samples"))
def topic_rates(spark, sf):
    return m.topic_rates(t.metric_samples(spark, sf)).withColumn("rate", F.round("rate", 6))


@query("w4_missing_instances", t.with_views("""
, s AS (SELECT metric, date_trunc('minute', ts) AS minute, count(DISTINCT instance) AS instances
        FROM metric_samples GROUP BY ALL HAVING count(DISTINCT instance) < 2)
SELECT a.metric, CAST(a.minute AS TIMESTAMP) AS minute, a.instances, b.minute IS NOT NULL AS firing FROM s a
LEFT JOIN s b ON a.metric = b.metric AND b.minute = a.minute - INTERVAL 1 MINUTE""", "metric_samples"))
def missing_instances(spark, sf):
    return m.missing_instances(t.metric_samples(spark, sf))


def _hourly(spark, sf):
    return t.metric_samples(spark, sf).select(
        F.date_trunc("day", "ts").cast("date").alias("day"), "topic", "value")


@query("w5_exact_quantiles", t.with_views("""
, q(quantile) AS (VALUES (0.5), (0.9), (0.99))
SELECT CAST(ts AS DATE) AS day, topic, CAST(0.5 AS DOUBLE) AS quantile, round(quantile_cont(value, 0.5), 6) AS value
FROM metric_samples GROUP BY 1, 2
UNION ALL SELECT CAST(ts AS DATE), topic, 0.9, round(quantile_cont(value, 0.9), 6) FROM metric_samples GROUP BY 1, 2
UNION ALL SELECT CAST(ts AS DATE), topic, 0.99, round(quantile_cont(value, 0.99), 6) FROM metric_samples GROUP BY 1, 2""",
                                          "metric_samples"))
def exact_quantiles(spark, sf):
    return m.exact_quantiles(_hourly(spark, sf), [0.5, 0.9, 0.99], ["day", "topic"]).withColumn(
        "value", F.round("value", 6))


# The sketch is exact while a group has fewer distinct values than its accuracy (10,000).
@query("w5_approximate_quantiles", t.with_views(" UNION ALL ".join(f"""
SELECT CAST(ts AS DATE) AS day, topic, CAST({q} AS DOUBLE) AS quantile, quantile_disc(value, {q}) AS value
FROM metric_samples GROUP BY 1, 2""" for q in (0.5, 0.9, 0.99)), "metric_samples"))
def approximate_quantiles(spark, sf):
    return m.quantiles(_hourly(spark, sf), [0.5, 0.9, 0.99], ["day", "topic"])
