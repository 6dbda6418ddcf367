"""Keeping one row per key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# A cart or purchase row counts once per item, price, user and session.
TARGET_KEY = ["event_type", "product_id", "price", "user_id", "user_session"]


def keep_first(df: DataFrame, keys: list[str], order: list[str | Column]) -> DataFrame:
    """First row of each key in ``order``, which should end in a unique column.

    Spark turns ``row_number() = 1`` into a group limit that runs before the shuffle as
    well, so every map task sends at most one row per key: a key that holds a large part
    of the table does not land in one task.
    """
    ranked = Window.partitionBy(*keys).orderBy(*order)
    return (df.withColumn("_rank", F.row_number().over(ranked))
              .where(F.col("_rank") == 1).drop("_rank"))
