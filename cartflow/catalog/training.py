"""The cart-to-purchase training table, whole and step by step."""

from pyspark.sql import functions as F

from cartflow.catalog.joins import ACTIVE, DEDUP
from cartflow.catalog.registry import query
from cartflow.operators.labels import activity_of_active_users
from cartflow.plans.training import (TRAINING_COLUMNS, add_item_columns, carted_items, training_table,
                                     training_table_by_join, training_table_complete_rows)
from cartflow.sources import tables as t

# The oracle follows the steps one by one, as they were first written down.
STEPS = DEDUP.replace("FROM behavior WHERE", f"FROM behavior WHERE {ACTIVE} AND") + f"""
, m AS (SELECT user_session, product_id, max(is_purchased) AS bought FROM d GROUP BY 1, 2),
c AS (SELECT * FROM (
  SELECT d.*, m.bought, row_number() OVER (PARTITION BY d.user_session, d.product_id, m.bought
                                           ORDER BY event_time, event_id) AS r2
  FROM d JOIN m ON d.user_session = m.user_session AND d.product_id = m.product_id
  WHERE event_type = 'cart') WHERE r2 = 1),
act AS (SELECT user_session, count(*) AS activity_count FROM behavior WHERE {ACTIVE} GROUP BY 1)"""

_PARTS = """
  substring(CAST(category_id AS VARCHAR), 1, 6) AS category_id_id1,
  substring(CAST(category_id AS VARCHAR), 7, 6) AS category_id_id2,
  substring(CAST(category_id AS VARCHAR), 13, 7) AS category_id_id3,
  coalesce(string_split(category_code, '.')[1], substring(CAST(category_id AS VARCHAR), 1, 6)) AS category_code_level1_f,
  coalesce(string_split(category_code, '.')[2], substring(CAST(category_id AS VARCHAR), 1, 6)) AS category_code_level2_f,
  coalesce(string_split(category_code, '.')[2], string_split(category_code, '.')[3],
           substring(CAST(category_id AS VARCHAR), 1, 6)) AS category_code_level3_f,
  coalesce(brand, substring(CAST(category_id AS VARCHAR), 1, 6)) AS brand_f,
  CAST(extract(hour FROM event_time) AS BIGINT) AS dt_hour,
  CAST(extract(day FROM event_time) AS BIGINT) AS dt_day,
  CAST(dayofweek(event_time) + 1 AS BIGINT) AS week_day"""

_SMALL = ("dt_hour", "dt_day", "week_day")


def _wide(df):
    return df.withColumns({c: F.col(c).cast("bigint") for c in _SMALL if c in df.columns})


@query("p10_training_table", t.with_views(f"""{STEPS}
SELECT {_PARTS}, price, coalesce(activity_count, 0) AS activity_count, bought AS is_purchased
FROM c LEFT JOIN act ON c.user_session = act.user_session""", "behavior"))
def table(spark, sf):
    return _wide(training_table(t.behavior(spark, sf)))


@query("p10_step_carted_items", t.with_views(f"""{STEPS}
SELECT event_id, event_time, event_type, product_id, category_id, category_code, brand, price, user_id,
       user_session, bought AS is_purchased FROM c""", "behavior"))
def step_carted_items(spark, sf):
    return carted_items(t.behavior(spark, sf))


@query("p10_step_item_columns", t.with_views(f"SELECT event_id, {_PARTS} FROM behavior", "behavior"))
def step_item_columns(spark, sf):
    items = add_item_columns(t.behavior(spark, sf))
    return _wide(items.select("event_id", *[c for c in items.columns if c in TRAINING_COLUMNS
                                            and c != "price"]))


@query("p10_step_activity_of_active_users", t.with_views(
    f"SELECT user_session, count(*) AS activity_count FROM behavior WHERE {ACTIVE} GROUP BY 1", "behavior"))
def step_activity(spark, sf):
    return activity_of_active_users(t.behavior(spark, sf))


@query("p10_training_table_join_form", t.with_views("""
, k AS (SELECT * FROM behavior WHERE category_code IS NOT NULL AND brand IS NOT NULL),
d AS (SELECT * FROM (SELECT *, row_number() OVER (
        PARTITION BY event_type, product_id, price, user_id, user_session ORDER BY event_time, event_id) AS r
      FROM k WHERE event_type IN ('cart', 'purchase')) WHERE r = 1),
act AS (SELECT user_session, count(*) AS activity_count FROM k GROUP BY user_session)
SELECT a.event_id, a.event_time, a.event_type, a.product_id, a.category_id, a.category_code, a.brand, a.price,
       a.user_id, a.user_session, CASE WHEN b.event_id IS NULL THEN 0 ELSE 1 END AS is_purchased,
       activity_count, string_split(a.category_code, '.')[1] AS category_code_level1,
       string_split(a.category_code, '.')[2] AS category_code_level2,
       string_split(a.category_code, '.')[3] AS category_code_level4,
       coalesce(string_split(a.category_code, '.')[2], string_split(a.category_code, '.')[3]) AS category_code_level3,
       CAST(dayofweek(a.event_time) + 1 AS BIGINT) AS week_day
FROM (SELECT * FROM d WHERE event_type = 'cart') a
LEFT JOIN (SELECT * FROM d WHERE event_type = 'purchase') b
  ON a.user_session = b.user_session AND a.product_id = b.product_id
JOIN act ON a.user_session = act.user_session""", "behavior"))
def table_join_form(spark, sf):
    return _wide(training_table_by_join(t.behavior(spark, sf)))


@query("p10_training_table_complete_rows", t.with_views(DEDUP + """
, m AS (SELECT user_session, product_id, max(is_purchased) AS bought FROM d GROUP BY 1, 2),
c AS (SELECT * FROM (
  SELECT d.*, m.bought, row_number() OVER (PARTITION BY d.user_session, d.product_id, m.bought
                                           ORDER BY event_time, event_id) AS r2
  FROM d JOIN m ON d.user_session = m.user_session AND d.product_id = m.product_id
  WHERE event_type = 'cart') WHERE r2 = 1 AND category_code IS NOT NULL AND brand IS NOT NULL),
u AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_time, event_id) AS r3
        FROM behavior WHERE event_type IN ('cart', 'purchase'))
      WHERE r3 = 1 AND category_code IS NOT NULL AND brand IS NOT NULL),
act AS (SELECT user_session, count(*) AS activity_count FROM behavior
        WHERE user_id IN (SELECT user_id FROM u) GROUP BY 1)
SELECT event_id, event_time, event_type, product_id, category_id, category_code, brand, price, user_id,
       c.user_session, bought AS is_purchased, CAST(isodow(event_time) - 1 AS VARCHAR) AS event_weekday,
       string_split(category_code, '.')[1] AS category_code_level1,
       string_split(category_code, '.')[2] AS category_code_level2,
       coalesce(activity_count, 0) AS activity_count
FROM c LEFT JOIN act ON c.user_session = act.user_session""", "behavior"))
def table_complete_rows(spark, sf):
    return training_table_complete_rows(t.behavior(spark, sf))
