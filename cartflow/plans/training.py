"""The cart-to-purchase training table: one row per carted item, with its label.

Three variants: ``training_table`` (all events of active users, id fallbacks for missing
brands and categories), ``training_table_by_join`` (rows with brand and category only,
label by left join) and ``training_table_complete_rows`` (complete rows, Monday-first
weekday).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartflow.functions.text import piece
from cartflow.functions.time import weekday_monday_first_text, weekday_sunday_first
from cartflow.operators.dedup import TARGET_KEY, keep_first
from cartflow.operators.labels import (ITEM, activity_in_session, activity_of_active_users,
                                       add_is_purchased, label_by_join, targets, with_activity)
from cartflow.plans.heavy import split_join
from cartflow.session import materialise

FIRST = ["event_time", "event_id"]

# The columns of the training table, in their order.
TRAINING_COLUMNS = [
    "category_id_id1", "category_id_id2", "category_id_id3", "category_code_level1_f",
    "category_code_level2_f", "category_code_level3_f", "brand_f", "price", "dt_hour", "dt_day",
    "week_day", "activity_count", "is_purchased",
]


def carted_items(df: DataFrame) -> DataFrame:
    """First cart row of each (session, product), with ``is_purchased``.

    Removing five-column duplicates first would not change the outcome: neither the
    first cart row nor the maximum depends on later copies. So the two steps are one
    hash aggregate (label) and one keep-first, joined on the key both are partitioned by.
    """
    label = (add_is_purchased(targets(df)).groupBy(*ITEM)
             .agg(F.max("is_purchased").alias("is_purchased")))
    carts = keep_first(df.where(F.col("event_type") == "cart"), ITEM, FIRST)
    return carts.join(label, ITEM).select(*df.columns, "is_purchased")


def add_time_parts(df: DataFrame) -> DataFrame:
    return df.withColumns({
        "week_day": weekday_sunday_first("event_time"),
        "dt_hour": F.hour("event_time"),
        "dt_day": F.dayofmonth("event_time"),
    })


def add_category_levels(df: DataFrame) -> DataFrame:
    """Levels 1, 2 and 4 are the three pieces of the code; level 3 falls back from 2 to 4."""
    levels = df.withColumns({
        "category_code_level1": piece("category_code", ".", 0),
        "category_code_level2": piece("category_code", ".", 1),
        "category_code_level4": piece("category_code", ".", 2),
    })
    return levels.withColumn("category_code_level3",
                             F.coalesce("category_code_level2", "category_code_level4"))


def add_category_id_parts(df: DataFrame) -> DataFrame:
    text = F.col("category_id").cast("string")
    return df.withColumns({
        "category_id_id1": F.substring(text, 1, 6),
        "category_id_id2": F.substring(text, 7, 6),
        "category_id_id3": F.substring(text, 13, 7),
    })


def add_fallbacks(df: DataFrame) -> DataFrame:
    """Missing levels and brands take the first part of the category id."""
    return df.withColumns({
        f"{c}_f": F.coalesce(c, "category_id_id1")
        for c in ("category_code_level1", "category_code_level2", "category_code_level3", "brand")
    })


def add_item_columns(df: DataFrame) -> DataFrame:
    """All row-wise columns of the training table; usable on a stream."""
    return (df.transform(add_time_parts).transform(add_category_levels)
              .transform(add_category_id_parts).transform(add_fallbacks))


def training_table(events: DataFrame, keep: list[str] = ()) -> DataFrame:
    """The training columns of every carted item; ``keep`` adds others, such as the row id."""
    # A carted item's user is active by definition, so only the activity count needs the
    # active-user filter.
    items = carted_items(events).transform(add_item_columns)
    counted = with_activity(items, activity_of_active_users(events))
    return counted.select(*keep, *TRAINING_COLUMNS).na.drop("any")


def training_table_by_join(events: DataFrame) -> DataFrame:
    known = events.na.drop(subset=["category_code", "brand"])
    labelled = label_by_join(keep_first(targets(known), TARGET_KEY, FIRST))
    counted = with_activity(labelled, activity_in_session(known), "inner")
    return (counted.transform(add_category_levels)
            .withColumn("week_day", weekday_sunday_first("event_time")))


def training_table_complete_rows(events: DataFrame, first_row_complete: bool = True) -> DataFrame:
    """``first_row_complete`` keeps a user only if the first cart or purchase row has no null."""
    first_rows = keep_first(targets(events), ["user_id"], FIRST)
    users = (first_rows.na.drop("any") if first_row_complete else first_rows).select("user_id")
    # Reduced to one row per (session, user) before users are matched; a user of very many sessions is split.
    per_user = materialise(events.where(F.col("user_session").isNotNull()).groupBy("user_session", "user_id")
                           .agg(F.count(F.lit(1)).alias("n")))
    activity = (split_join(per_user, users, ["user_id"], "inner")
                .groupBy("user_session").agg(F.sum("n").alias("activity_count")))
    items = carted_items(events).na.drop("any")
    return with_activity(items.withColumns({
        "event_weekday": weekday_monday_first_text("event_time"),
        "category_code_level1": piece("category_code", ".", 0),
        "category_code_level2": piece("category_code", ".", 1),
    }), activity)
