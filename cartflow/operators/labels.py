"""Active users, purchase labels and session activity."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartflow.plans.heavy import split_join
from cartflow.session import materialise

TARGET_TYPES = ["cart", "purchase"]
ITEM = ["user_session", "product_id"]


def targets(df: DataFrame) -> DataFrame:
    """Cart and purchase rows."""
    return df.where(F.col("event_type").isin(TARGET_TYPES))


def add_is_purchased(df: DataFrame) -> DataFrame:
    return df.withColumn("is_purchased", F.when(F.col("event_type") == "purchase", 1).otherwise(0))


def active_users_only(df: DataFrame) -> DataFrame:
    """Rows of users who have a cart or purchase row."""
    # Stored, so that adaptive execution can split a hot user.
    users = materialise(targets(df).select("user_id").distinct())
    return df.join(users, "user_id", "left_semi").select(*df.columns)


def label_by_max(df: DataFrame) -> DataFrame:
    """One row per input row: was this product bought in this session?

    Aggregate and join back (null sessions and products included). A window maximum would
    buffer a whole (session, product) group in one task. The labels are stored first, so
    that both sides of the join come straight from a shuffle, which is what lets adaptive
    execution split a hot key.
    """
    flagged = add_is_purchased(df)
    label = materialise(flagged.groupBy(*[F.col(c).alias(f"_{c}") for c in ITEM])
                        .agg(F.max("is_purchased").alias("is_purchased")))
    same = F.lit(True)
    for c in ITEM:
        same &= F.col(c).eqNullSafe(F.col(f"_{c}"))
    return df.join(label, same).select(*df.columns, "is_purchased")


def label_with_copies(df: DataFrame) -> DataFrame:
    """Cart rows with ``is_purchased`` and ``copies``: how often a left join to the purchase rows would give each.

    The purchases are counted per item first, so the join is one to one.
    """
    # Stored, so that adaptive execution can split a hot key of the carts.
    bought = materialise(df.where(F.col("event_type") == "purchase").groupBy(*ITEM)
                         .agg(F.count(F.lit(1)).alias("_purchases")), eager=False)
    carts = df.where(F.col("event_type") == "cart").join(bought, ITEM, "left")
    return carts.select(*df.columns, F.when(F.col("_purchases").isNotNull(), 1).otherwise(0).alias("is_purchased"),
                        F.coalesce("_purchases", F.lit(1)).alias("copies"))


def label_by_join(df: DataFrame) -> DataFrame:
    """Cart rows left-joined to the purchase rows of the same item and session.

    A cart row comes out once for every matching purchase row, as the join says; of data without duplicates that is once.
    """
    copies = F.sequence(F.lit(1), F.col("copies").cast("int"))
    return label_with_copies(df).select(*df.columns, "is_purchased", F.explode(copies).alias("_copy")).drop("_copy")


def activity_in_session(df: DataFrame) -> DataFrame:
    """Events per session."""
    return df.groupBy("user_session").agg(F.count(F.lit(1)).alias("activity_count"))


def activity_of_active_users(df: DataFrame) -> DataFrame:
    """Events per session, counting active users only.

    Rows are first reduced to one per (session, user), and the semi join runs on that, not
    on the events.
    """
    per_user = df.groupBy("user_session", "user_id").agg(F.count(F.lit(1)).alias("n"))
    users = targets(df).select("user_id").distinct()
    return (per_user.join(users, "user_id", "left_semi")
            .groupBy("user_session").agg(F.sum("n").alias("activity_count")))


def with_activity(df: DataFrame, activity: DataFrame, how: str = "left", split: bool = False) -> DataFrame:
    """Attach ``activity_count`` by session; a session without one gets 0.

    With ``split`` sessions that hold much of ``df`` are joined where they are read (``split_join``); ``df`` is then
    read several times, so it should be cheap to read.
    """
    joined = split_join(df, activity, ["user_session"], how) if split else df.join(activity, "user_session", how)
    return joined.select(*df.columns, "activity_count").fillna(0, subset=["activity_count"])
