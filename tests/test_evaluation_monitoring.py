"""Evaluation against Spark ML's evaluators; rates, alerts and quantiles against brute force."""

import datetime as dt
import random
import statistics

import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator, MulticlassClassificationEvaluator
from pyspark.sql import functions as F

from cartflow.operators import evaluation as e
from cartflow.operators import monitoring as m
from cartflow.schemas import METRIC_SAMPLES
from cartflow.sources.tables import scores


def test_measures_equal_the_evaluators(spark, sf_dir):
    table = scores(spark, sf_dir).withColumns({c: F.col(c).cast("double") for c in ("label", "prediction")})
    evaluator = BinaryClassificationEvaluator(rawPredictionCol="score", numBins=0)
    for slices in (None, 7):
        assert e.area_under_roc(table, slices).first()[0] == pytest.approx(evaluator.evaluate(table), abs=1e-9)
    many = MulticlassClassificationEvaluator(metricName="weightedFMeasure", beta=0.5)
    assert e.weighted_fbeta(table).first()[0] == pytest.approx(many.evaluate(table), abs=1e-9)
    assert e.accuracy(table).first()[0] == pytest.approx(
        MulticlassClassificationEvaluator(metricName="accuracy").evaluate(table), abs=1e-9)


def test_one_class_only(spark):
    table = spark.createDataFrame([(1, 0.5, 1)], "label int, score double, prediction int")
    assert e.area_under_roc(table).first()[0] is None
    assert tuple(e.precision_recall(table).first()) == (1.0, 1.0)


START = dt.datetime(2024, 1, 1)


def _samples(seed):
    draw = random.Random(seed)
    rows = []
    for instance in (0, 1):
        second, value = 0, 0.0
        for _ in range(150):
            second += draw.choice([1, 20, 90, 400, 5000])
            value = 1.0 if draw.random() < 0.1 else value + draw.randint(0, 9)
            rows.append((START + dt.timedelta(seconds=second), "m", "t", instance, value))
    return rows


def _brute_rate(rows, span):
    out = {}
    for instance in (0, 1):
        series = sorted(r for r in rows if r[3] == instance)
        grown = [0.0] + [b[4] if b[4] < a[4] else b[4] - a[4] for a, b in zip(series, series[1:])]
        for row in series:
            low = row[0] - dt.timedelta(seconds=span)
            out[(row[0], instance)] = sum(g for r, g in zip(series, grown) if low <= r[0] <= row[0]) / span
    return out


@pytest.mark.parametrize("chunk", [300, 450, 3600, 10 ** 7])
def test_rate_does_not_depend_on_chunks(spark, chunk):
    rows = _samples(chunk)
    got = m.counter_rate(spark.createDataFrame(rows, METRIC_SAMPLES), 300, chunk_seconds=chunk).collect()
    assert len(got) == len(rows)
    expected = _brute_rate(rows, 300)
    for r in got:
        assert r.rate == pytest.approx(expected[(r.ts, r.instance)])


def test_chunk_shorter_than_window(spark):
    with pytest.raises(ValueError):
        m.counter_rate(spark.createDataFrame(_samples(1), METRIC_SAMPLES), 300, chunk_seconds=60)


def test_sum_without_leaves_out_empty_topics(spark):
    rows = [(START, "m", "t", 0, 1.0), (START + dt.timedelta(seconds=30), "m", "t", 0, 3.0),
            (START, "m", "t", 1, 5.0), (START, "m", "", 1, 9.0)]
    got = m.sum_without(spark.createDataFrame(rows, METRIC_SAMPLES), "value", ["instance"]).collect()
    assert [(r.topic, r.value) for r in got] == [("t", 8.0)]


def test_alert_needs_the_whole_hold(spark):
    minutes = {0: [0, 1], 1: [0], 2: [0], 3: [0], 5: [1], 6: [0, 1], 7: [1]}
    rows = [(START + dt.timedelta(minutes=k), "m", "t", i, 1.0) for k, v in minutes.items() for i in v]
    table = spark.createDataFrame(rows, METRIC_SAMPLES)
    firing = lambda hold: [r.minute.minute for r in m.missing_instances(table, 2, hold).where("firing")
                           .orderBy("minute").collect()]
    assert firing(0) == [1, 2, 3, 5, 7]
    assert firing(1) == [2, 3]
    assert firing(2) == [3]


@pytest.mark.parametrize("slices", [1, 6])
def test_exact_quantiles(spark, slices):
    draw = random.Random(3)
    rows = [("hot" if draw.random() < 0.8 else "cold", float(draw.randint(0, 40))) for _ in range(500)] + [("one", 4.0)]
    got = m.exact_quantiles(spark.createDataFrame(rows, "g string, value double"), [0.0, 0.25, 0.5, 1.0], ["g"], slices)
    for r in got.collect():
        data = sorted(v for g, v in rows if g == r.g)
        place = r.quantile * (len(data) - 1)
        low = int(place)
        high = min(low + 1, len(data) - 1)
        assert r.value == pytest.approx(data[low] + (data[high] - data[low]) * (place - low))
    assert got.count() == 12
    assert statistics.median(v for g, v in rows if g == "hot") == got.where("g = 'hot' and quantile = 0.5").first().value


def test_rates_with_equal_times_and_idle_windows(spark):
    """Equal times come by value whatever the row order; a window without an increase has a rate of exactly 0."""
    rows = [(0, 1.0), (10, 1.1), (10, 1.4), (20, 1.7), (1000, 1.7), (1010, 1.7)]
    rates = []
    for order in (rows, rows[::-1]):
        df = spark.createDataFrame(order, "s long, value double").select(
            F.timestamp_seconds("s").cast("timestamp_ntz").alias("ts"), F.lit("m").alias("metric"), F.lit("t").alias("topic"),
            F.lit(0).alias("instance"), "value", "s")
        rates.append({(r["s"], r["value"]): r["rate"] for r in m.counter_rate(df.repartition(3), 300).collect()})
    assert rates[0] == rates[1]
    assert rates[0][20, 1.7] == pytest.approx(0.7 / 300) and rates[0][10, 1.1] == rates[0][10, 1.4] == pytest.approx(0.4 / 300)
    assert rates[0][1000, 1.7] == 0 and rates[0][1010, 1.7] == 0
