"""Joins."""

from pyspark.sql import functions as F

from cartflow.catalog.registry import query
from cartflow.operators.dedup import TARGET_KEY, keep_first
from cartflow.operators.labels import (active_users_only, activity_in_session, label_by_join,
                                       label_by_max, targets, with_activity)
from cartflow.plans.heavy import split_join
from cartflow.plans.training import FIRST
from cartflow.sources import tables as t

DEDUP = """
, d AS (SELECT * FROM (SELECT *, CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END AS is_purchased,
          row_number() OVER (PARTITION BY event_type, product_id, price, user_id, user_session
                             ORDER BY event_time, event_id) AS r
        FROM behavior WHERE event_type IN ('cart', 'purchase')) WHERE r = 1)"""
ACTIVE = "user_id IN (SELECT DISTINCT user_id FROM behavior WHERE event_type IN ('cart', 'purchase'))"


def _deduped(spark, sf):
    return keep_first(targets(t.behavior(spark, sf)), TARGET_KEY, FIRST)


@query("c1_label_by_left_join", t.with_views(DEDUP + """
SELECT a.event_id, a.user_session, a.product_id, coalesce(b.is_purchased, a.is_purchased) AS is_purchased
FROM (SELECT * FROM d WHERE event_type = 'cart') a
LEFT JOIN (SELECT * FROM d WHERE event_type = 'purchase') b
ON a.user_session = b.user_session AND a.product_id = b.product_id""", "behavior"))
def label_left_join(spark, sf):
    return label_by_join(_deduped(spark, sf)).select(
        "event_id", "user_session", "product_id", "is_purchased")


@query("c1_label_by_left_join_raw_rows", t.with_views("""
SELECT a.event_id, CASE WHEN b.user_session IS NULL THEN 0 ELSE 1 END AS is_purchased
FROM (SELECT * FROM behavior WHERE event_type = 'cart') a
LEFT JOIN (SELECT * FROM behavior WHERE event_type = 'purchase') b
ON a.user_session = b.user_session AND a.product_id = b.product_id""", "behavior"))
def label_left_join_raw(spark, sf):
    # Without the duplicates removed a cart row comes out once per purchase row.
    return label_by_join(t.behavior(spark, sf)).select("event_id", "is_purchased")


@query("c2_inner_join_activity", t.with_views("""
SELECT a.event_id, a.user_session, n.activity_count FROM behavior a
JOIN (SELECT user_session, count(*) AS activity_count FROM behavior
      WHERE category_code IS NOT NULL AND brand IS NOT NULL GROUP BY user_session) n
ON a.user_session = n.user_session WHERE a.event_type = 'cart'""", "behavior"))
def inner_join_activity(spark, sf):
    events = t.behavior(spark, sf)
    counts = activity_in_session(events.na.drop(subset=["category_code", "brand"]))
    carts = events.where(F.col("event_type") == "cart").select("event_id", "user_session")
    return split_join(carts, counts, ["user_session"], "inner").select("event_id", "user_session", "activity_count")


@query("c3_label_by_group_max", t.with_views(DEDUP + """
SELECT d.event_id, d.event_type, m.is_purchased FROM d
JOIN (SELECT user_session, product_id, max(is_purchased) AS is_purchased FROM d GROUP BY 1, 2) m
ON d.user_session = m.user_session AND d.product_id = m.product_id""", "behavior"))
def label_group_max(spark, sf):
    return label_by_max(_deduped(spark, sf)).select("event_id", "event_type", "is_purchased")


@query("c4_left_join_fill_zero", t.with_views("""
SELECT a.event_id, coalesce(n.activity_count, 0) AS activity_count FROM behavior a
LEFT JOIN (SELECT user_session, count(*) AS activity_count FROM behavior
           WHERE event_type = 'purchase' GROUP BY user_session) n
ON a.user_session = n.user_session""", "behavior"))
def left_join_fill_zero(spark, sf):
    events = t.behavior(spark, sf)
    counts = activity_in_session(events.where(F.col("event_type") == "purchase"))
    return with_activity(events.select("event_id", "user_session"), counts, split=True).select(
        "event_id", "activity_count")


@query("c5_active_users", t.with_views(
    f"SELECT event_id, user_id, event_type FROM behavior WHERE {ACTIVE}", "behavior"))
def active_users(spark, sf):
    return active_users_only(t.behavior(spark, sf)).select("event_id", "user_id", "event_type")


@query("c5_active_users_in_sql", t.with_views(
    f"SELECT user_session, count(*) AS n FROM behavior WHERE {ACTIVE} GROUP BY user_session", "behavior"))
def active_users_sql(spark, sf):
    t.behavior(spark, sf).createOrReplaceTempView("shop_events")
    return spark.sql("""
        SELECT user_session, count(*) AS n FROM shop_events
        WHERE user_id IN (SELECT DISTINCT user_id FROM shop_events WHERE event_type IN ('cart', 'purchase'))
        GROUP BY user_session""")


@query("c6_buyers_by_id_table", t.with_views("""
SELECT event_id, user_id FROM behavior
WHERE user_id IN (SELECT user_id FROM behavior WHERE event_type IN ('cart', 'purchase'))""", "behavior"))
def buyers_by_id_table(spark, sf):
    # The id list stays a table; it is never collected into the plan.
    events = t.behavior(spark, sf)
    ids = targets(events).select("user_id").distinct()
    return split_join(events.select("event_id", "user_id"), ids, ["user_id"], "inner").select("event_id", "user_id")


@query("c7_transaction_identity", t.with_views("""
SELECT t.transaction_id, t.is_fraud, round(t.transaction_amt, 6) AS transaction_amt, i.device_info, i.id_31
FROM transactions t LEFT JOIN identity_info i ON t.transaction_id = i.transaction_id""",
                                               "transactions", "identity_info"))
def transaction_identity(spark, sf):
    return t.transactions(spark, sf).join(t.identity_info(spark, sf), "transaction_id", "left").select(
        "transaction_id", "is_fraud", F.round("transaction_amt", 6).alias("transaction_amt"),
        "device_info", "id_31")
