"""Evaluation of a ``(label, score, prediction)`` table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartflow.plans.ordered import running_totals


def accuracy(df: DataFrame) -> DataFrame:
    return df.agg(F.avg((F.col("label") == F.col("prediction")).cast("int")).alias("accuracy"))


def precision_recall(df: DataFrame) -> DataFrame:
    """Of the positive class; null where the denominator is zero."""
    hit = F.count_if((F.col("label") == 1) & (F.col("prediction") == 1))
    return df.agg(
        F.try_divide(hit, F.count_if(F.col("prediction") == 1)).alias("precision"),
        F.try_divide(hit, F.count_if(F.col("label") == 1)).alias("recall"))


def confusion_matrix(df: DataFrame) -> DataFrame:
    return df.groupBy("label", "prediction").agg(F.count(F.lit(1)).alias("n"))


def weighted_fbeta(df: DataFrame, beta: float = 0.5) -> DataFrame:
    """F-beta of every class, weighted by its number of rows.

    Works on class counts: each (label, prediction) cell goes once to its label as
    support and once to its prediction as predicted rows.
    """
    cells = confusion_matrix(df)
    same = F.when(F.col("label") == F.col("prediction"), F.col("n")).otherwise(0)
    sides = F.array(
        F.struct(F.col("label").cast("double").alias("class"), F.col("n").alias("support"),
                 F.lit(0).cast("bigint").alias("predicted"), same.alias("hit")),
        F.struct(F.col("prediction").cast("double").alias("class"),
                 F.lit(0).cast("bigint").alias("support"), F.col("n").alias("predicted"),
                 F.lit(0).cast("bigint").alias("hit")))
    classes = cells.select(F.inline(sides)).groupBy("class").agg(
        *[F.sum(c).alias(c) for c in ("support", "predicted", "hit")])
    b2 = beta * beta
    score = F.coalesce(F.try_divide((1 + b2) * F.col("hit"),
                                    b2 * F.col("support") + F.col("predicted")), F.lit(0.0))
    return classes.agg((F.sum(score * F.col("support")) / F.sum("support")).alias("fbeta"))


def _by_score(df: DataFrame, group: list[str] = ()) -> DataFrame:
    return df.groupBy(*group, "score").agg(F.count_if(F.col("label") == 1).alias("pos"),
                                           F.count_if(F.col("label") == 0).alias("neg"))


def area_under_roc(df: DataFrame, slices: int | None = None, group: list[str] = ()) -> DataFrame:
    """Chance that a positive outscores a negative, ties counting one half; one row, or one for each ``group``.

    Rows are counted per distinct score first. The negatives below each score come from
    range-sliced running totals, so distinct scores may be as many as rows.
    """
    totals = running_totals(_by_score(df, group), ["score"], {"neg_upto": F.col("neg")}, group, slices)
    won = F.col("pos") * (F.col("neg_upto") - F.col("neg") / 2)
    return totals.groupBy(*group).agg(F.try_divide(F.sum(won), F.sum("pos") * F.sum("neg").cast("double"))
                                      .alias("area_roc"))


def roc_points(df: DataFrame, slices: int | None = None) -> DataFrame:
    """``(score, fpr, tpr)``: the rates when everything at or above the score is called positive."""
    by_score = _by_score(df)
    totals = running_totals(by_score, [F.desc("score")],
                            {"fp": F.col("neg"), "tp": F.col("pos")}, slices=slices)
    whole = df.agg(F.count_if(F.col("label") == 1).alias("p"), F.count_if(F.col("label") == 0).alias("n"))
    return totals.select("score",
                         F.try_divide(F.col("fp"), whole.select("n").scalar()).alias("fpr"),
                         F.try_divide(F.col("tp"), whole.select("p").scalar()).alias("tpr"))
