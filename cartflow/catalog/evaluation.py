"""Evaluation on a deterministic score table."""

from pyspark.sql import functions as F

from cartflow.catalog.registry import query
from cartflow.operators import evaluation as e
from cartflow.sources import tables as t


def _rounded(df, *columns):
    return df.withColumns({c: F.round(c, 6) for c in columns})


@query("v1_accuracy", t.with_views("""
SELECT round(avg(CASE WHEN label = prediction THEN 1.0 ELSE 0.0 END), 6) AS accuracy FROM scores""", "scores"))
def accuracy(spark, sf):
    return _rounded(e.accuracy(t.scores(spark, sf)), "accuracy")


@query("v2_area_under_roc", t.with_views("""
, g AS (SELECT score, CAST(sum(label) AS DOUBLE) AS p, CAST(sum(1 - label) AS DOUBLE) AS n FROM scores GROUP BY score),
r AS (SELECT p, n, sum(n) OVER (ORDER BY score) - n AS below FROM g)
SELECT round(sum(p * (below + n / 2)) / (sum(p) * sum(n)), 6) AS area_roc FROM r""", "scores"))
def area(spark, sf):
    return _rounded(e.area_under_roc(t.scores(spark, sf)), "area_roc")


@query("v3_precision_recall", t.with_views("""
SELECT round(count(*) FILTER (label = 1 AND prediction = 1) / count(*) FILTER (prediction = 1), 6) AS precision,
       round(count(*) FILTER (label = 1 AND prediction = 1) / count(*) FILTER (label = 1), 6) AS recall
FROM scores""", "scores"))
def precision_recall(spark, sf):
    return _rounded(e.precision_recall(t.scores(spark, sf)), "precision", "recall")


@query("v4_weighted_fbeta", t.with_views("""
, k AS (SELECT c, count(*) FILTER (label = c) AS support, count(*) FILTER (prediction = c) AS predicted,
               count(*) FILTER (label = c AND prediction = c) AS hit
        FROM scores, (VALUES (0), (1)) v(c) GROUP BY c)
SELECT round(sum(support * 1.25 * hit / (0.25 * support + predicted)) / sum(support), 6) AS fbeta FROM k""",
                                         "scores"))
def fbeta(spark, sf):
    return _rounded(e.weighted_fbeta(t.scores(spark, sf)), "fbeta")


@query("v5_roc_points", t.with_views("""
, g AS (SELECT score, CAST(sum(label) AS BIGINT) AS p, CAST(sum(1 - label) AS BIGINT) AS n FROM scores GROUP BY score)
SELECT round(score, 6) AS score,
       round(sum(n) OVER (ORDER BY score DESC) / sum(n) OVER (), 6) AS fpr,
       round(sum(p) OVER (ORDER BY score DESC) / sum(p) OVER (), 6) AS tpr FROM g""", "scores"))
def roc(spark, sf):
    return _rounded(e.roc_points(t.scores(spark, sf)), "score", "fpr", "tpr")


@query("v7_confusion_matrix", t.with_views("""
SELECT label, prediction, count(*) AS n FROM scores GROUP BY label, prediction""", "scores"))
def confusion(spark, sf):
    return e.confusion_matrix(t.scores(spark, sf))
