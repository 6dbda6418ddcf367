"""Window shapes, sorting, limits, set operations."""

from pyspark.sql import functions as F

from cartflow.catalog.registry import query
from cartflow.operators.dedup import keep_first
from cartflow.operators import funnel
from cartflow.operators.explore import session_journey, share_of_total, top_values
from cartflow.operators.labels import label_by_max
from cartflow.operators.sampling import ordered_limit, repeat_rows
from cartflow.plans.training import FIRST
from cartflow.session import materialise
from cartflow.sources import tables as t


@query("e1_group_max_on_rows", t.with_views("""
SELECT event_id, max(CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END)
       OVER (PARTITION BY user_session, product_id) AS is_purchased FROM behavior""", "behavior"))
def group_max_on_rows(spark, sf):
    return label_by_max(t.behavior(spark, sf)).select("event_id", "is_purchased")


@query("e2_first_row_per_user", t.with_views("""
SELECT user_id, event_id, event_type FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_time, event_id) AS r FROM behavior
) WHERE r = 1""", "behavior"))
def first_row_per_user(spark, sf):
    return keep_first(t.behavior(spark, sf), ["user_id"], FIRST).select("user_id", "event_id", "event_type")


@query("e3_share_of_brand", t.with_views("""
SELECT brand, count(*) AS n, round(count(*) * 100.0 / sum(count(*)) OVER (), 6) AS percent
FROM behavior GROUP BY brand""", "behavior"))
def share_of_brand(spark, sf):
    return share_of_total(t.behavior(spark, sf), "brand").withColumn("percent", F.round("percent", 6))


@query("e4_session_journey", t.with_views("""
SELECT user_session, event_id, event_time, event_type, product_id,
       row_number() OVER (PARTITION BY user_session ORDER BY event_time, event_id) AS step,
       lag(event_type) OVER (PARTITION BY user_session ORDER BY event_time, event_id) AS previous_type
FROM behavior""", "behavior"))
def journey(spark, sf):
    events = t.behavior(spark, sf).select("user_session", "event_id", "event_time", "event_type", "product_id")
    return session_journey(events)


# First view, first cart after it, first purchase after that: positions in the session, null where the step is not reached.
_FUNNEL = """
, o AS (SELECT user_session, event_id, event_type, row_number() OVER (PARTITION BY user_session ORDER BY event_time, event_id) AS r FROM behavior),
s1 AS (SELECT user_session, min(r) FILTER (event_type = 'view') AS r1 FROM o GROUP BY user_session),
s2 AS (SELECT s1.user_session, r1, min(r) FILTER (event_type = 'cart' AND r > r1) AS r2
       FROM s1 JOIN o ON o.user_session IS NOT DISTINCT FROM s1.user_session GROUP BY 1, 2),
s3 AS (SELECT s2.user_session, r1, r2, min(r) FILTER (event_type = 'purchase' AND r > r2) AS r3
       FROM s2 JOIN o ON o.user_session IS NOT DISTINCT FROM s2.user_session GROUP BY 1, 2, 3),
f AS (SELECT user_session, CASE WHEN r3 IS NOT NULL THEN 3 WHEN r2 IS NOT NULL THEN 2 WHEN r1 IS NOT NULL THEN 1 ELSE 0 END::INT AS stage FROM s3)"""


def _shop_steps():
    return [F.col("event_type") == kind for kind in ("view", "cart", "purchase")]


@query("e4_funnel_stages", t.with_views(f"""{_FUNNEL}
SELECT event_id, (CASE WHEN r >= r3 THEN 3 WHEN r >= r2 THEN 2 WHEN r >= r1 THEN 1 ELSE 0 END)::INT AS stage
FROM o JOIN s3 ON o.user_session IS NOT DISTINCT FROM s3.user_session""", "behavior"))
def funnel_stages(spark, sf):
    events = t.behavior(spark, sf).select("event_id", "event_time", "user_session", "event_type")
    return funnel.funnel_stages(events, ["event_time", "event_id"], ["user_session"], _shop_steps()).select("event_id", "stage")


@query("e4_funnel_by_session", t.with_views(f"{_FUNNEL} SELECT user_session, stage FROM f", "behavior"))
def funnel_by_session(spark, sf):
    return funnel.furthest_stage(t.behavior(spark, sf), ["event_time", "event_id"], ["user_session"], _shop_steps())


@query("e4_funnel_counts", t.with_views(f"""{_FUNNEL}
SELECT s.stage::INT AS stage, count(f.stage) AS n_groups, round(count(f.stage) * 100.0 / (SELECT count(*) FROM f), 6) AS percent
FROM range(4) AS s(stage) LEFT JOIN f ON f.stage >= s.stage GROUP BY 1""", "behavior"))
def funnel_counts(spark, sf):
    found = funnel.furthest_stage(t.behavior(spark, sf), ["event_time", "event_id"], ["user_session"], _shop_steps())
    return funnel.funnel_counts(materialise(found), 3).withColumn("percent", F.round("percent", 6))


@query("f1_sorted_purchases", t.with_views("""
SELECT event_id, event_time, price FROM behavior WHERE event_type = 'purchase'
ORDER BY price DESC, event_id""", "behavior"))
def sorted_purchases(spark, sf):
    return (t.behavior(spark, sf).where(F.col("event_type") == "purchase")
            .select("event_id", "event_time", "price").orderBy(F.desc("price"), "event_id"))


@query("f2_top_products", t.with_views("""
SELECT product_id, count(*) AS n FROM behavior GROUP BY product_id ORDER BY n DESC, product_id LIMIT 10""",
                                       "behavior"))
def top_products(spark, sf):
    return top_values(t.behavior(spark, sf), ["product_id"], 10)


@query("f3_ordered_limit", t.with_views("""
SELECT event_id, event_time, event_type FROM behavior ORDER BY event_time, event_id LIMIT 500""", "behavior"))
def first_rows(spark, sf):
    return ordered_limit(t.behavior(spark, sf).select("event_id", "event_time", "event_type"), 500, FIRST)


@query("f4_first_row", t.with_views("""
SELECT doc_id, doc, timestamp_, myid FROM times ORDER BY timestamp_, doc_id LIMIT 1""", "times"))
def first_row(spark, sf):
    return ordered_limit(t.times(spark, sf), 1, ["timestamp_", "doc_id"])


@query("g1_union_all", t.with_views("""
SELECT event_id, event_type FROM behavior WHERE event_type = 'cart'
UNION ALL SELECT event_id, event_type FROM behavior WHERE event_type = 'purchase'
UNION ALL SELECT event_id, event_type FROM behavior WHERE event_type = 'cart'""", "behavior"))
def union_all(spark, sf):
    events = t.behavior(spark, sf).select("event_id", "event_type")
    carts, bought = (events.where(F.col("event_type") == kind) for kind in ("cart", "purchase"))
    return carts.unionByName(bought).unionByName(carts)


@query("g2_repeat_rows", t.with_views("""
SELECT event_id, product_id FROM behavior, range(3) WHERE event_type = 'purchase'""", "behavior"))
def repeated(spark, sf):
    bought = t.behavior(spark, sf).where(F.col("event_type") == "purchase")
    return repeat_rows(bought.select("event_id", "product_id"), 3)
