"""Aggregations."""

from pyspark.sql import functions as F

from cartflow.catalog.registry import query
from cartflow.operators import sketches
from cartflow.operators.dedup import TARGET_KEY, keep_first
from cartflow.operators.explore import (daily_unique_visitors, histogram, share_of_total, top_values,
                                        unique_visitors)
from cartflow.operators.labels import ITEM, activity_in_session, add_is_purchased, targets
from cartflow.plans.training import FIRST
from cartflow.session import work_folder
from cartflow.sources import tables as t


@query("d1_events_per_session", t.with_views("""
SELECT user_session, count(*) AS activity_count FROM behavior GROUP BY user_session""", "behavior"))
def events_per_session(spark, sf):
    return activity_in_session(t.behavior(spark, sf))


@query("d2_purchased_in_session", t.with_views("""
SELECT user_session, product_id, max(CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END) AS is_purchased
FROM behavior WHERE event_type IN ('cart', 'purchase') GROUP BY user_session, product_id""", "behavior"))
def purchased_in_session(spark, sf):
    return (add_is_purchased(targets(t.behavior(spark, sf))).groupBy(*ITEM)
            .agg(F.max("is_purchased").alias("is_purchased")))


@query("d3_brand_top_sellers", t.with_views("""
SELECT brand, count(*) AS n FROM behavior WHERE event_type = 'purchase' AND brand IS NOT NULL
GROUP BY brand ORDER BY n DESC, brand LIMIT 20""", "behavior"))
def brand_top_sellers(spark, sf):
    bought = t.behavior(spark, sf).where((F.col("event_type") == "purchase") & F.col("brand").isNotNull())
    return top_values(bought, ["brand"], 20)


@query("d4_product_top_sellers", t.with_views("""
SELECT product_id, category_code, brand, count(*) AS n FROM behavior
WHERE event_type = 'purchase' AND category_code IS NOT NULL AND brand IS NOT NULL
GROUP BY product_id, category_code, brand ORDER BY n DESC, product_id, category_code, brand LIMIT 20""",
                                              "behavior"))
def product_top_sellers(spark, sf):
    bought = t.behavior(spark, sf).where(F.col("event_type") == "purchase").na.drop("any")
    return top_values(bought, ["product_id", "category_code", "brand"], 20)


@query("d5_unique_visitors", t.with_views(
    "SELECT count(DISTINCT user_id) AS visitors FROM behavior", "behavior"))
def visitors(spark, sf):
    return unique_visitors(t.behavior(spark, sf))


@query("d5_unique_visitors_approximate")
def visitors_approximate(spark, sf):
    return unique_visitors(t.behavior(spark, sf), approximate=True)


@query("d5_approximate_within_error", t.with_views(
    "SELECT count(DISTINCT user_id) AS visitors, true AS within_error FROM behavior", "behavior"))
def approximate_within_error(spark, sf):
    events = t.behavior(spark, sf)
    estimate = F.col("estimate").cast("double")
    return unique_visitors(events).withColumn(
        "estimate", unique_visitors(events, approximate=True).scalar()).select(
        "visitors", (F.abs(estimate - F.col("visitors")) <= 0.15 * F.col("visitors")).alias("within_error"))


@query("d6_visitors_of_seven_days", t.with_views(f"""
, days AS (SELECT DISTINCT CAST(event_time AS DATE) AS day FROM behavior),
own AS (SELECT DISTINCT CAST(event_time AS DATE) AS day, user_id FROM behavior)
SELECT days.day - 6 AS first_day, days.day AS last_day, count(DISTINCT user_id) AS visitors, true AS within_error
FROM days JOIN own ON own.day BETWEEN days.day - 6 AND days.day GROUP BY 1, 2""", "behavior"))
def visitors_of_seven_days(spark, sf):
    """Sketches are stored by day, read again and merged; beside them the exact numbers that they must come close to."""
    events, path = t.behavior(spark, sf), work_folder(spark, "sketches")
    sketches.save_days(sketches.daily_sketches(events), path)
    days = sketches.stored_days(spark, path)
    ranges = sketches.days_up_to(days.select("day"), 7)
    estimated = sketches.distinct_over(days, ranges).withColumnRenamed("visitors", "estimate")
    own = events.select(F.to_date("event_time").alias("day"), "user_id").distinct()
    exact = own.select(F.explode(F.sequence(F.col("day"), F.date_add("day", 6))).alias("last_day"), "user_id").groupBy(
        "last_day").agg(F.count_distinct("user_id").alias("visitors"))
    near = F.abs(F.col("estimate") - F.col("visitors")) <= F.greatest(F.lit(1.0), sketches.ERROR * F.col("visitors"))
    return estimated.join(exact, "last_day").select("first_day", "last_day", "visitors", near.alias("within_error"))


@query("d6_daily_unique_visitors", t.with_views("""
SELECT CAST(event_time AS DATE) AS event_date, count(DISTINCT user_id) AS visitors
FROM behavior GROUP BY 1 ORDER BY 1""", "behavior"))
def daily_visitors(spark, sf):
    return daily_unique_visitors(t.behavior(spark, sf)).orderBy("event_date")


@query("d7_top_categories", t.with_views("""
SELECT category_code, count(*) AS n FROM behavior WHERE category_code IS NOT NULL
GROUP BY category_code ORDER BY n DESC, category_code LIMIT 30""", "behavior"))
def top_categories(spark, sf):
    return top_values(t.behavior(spark, sf).where(F.col("category_code").isNotNull()), ["category_code"], 30)


@query("d8_event_type_shares", t.with_views("""
SELECT event_type, count(*) AS n, round(count(*) * 100.0 / sum(count(*)) OVER (), 6) AS percent
FROM behavior GROUP BY event_type""", "behavior"))
def event_type_shares(spark, sf):
    return share_of_total(t.behavior(spark, sf), "event_type").withColumn("percent", F.round("percent", 6))


@query("d9_distinct_users", t.with_views("""
SELECT DISTINCT user_id FROM behavior WHERE event_type IN ('cart', 'purchase')""", "behavior"))
def distinct_users(spark, sf):
    return targets(t.behavior(spark, sf)).select("user_id").distinct()


@query("d10_dedup_five_columns", t.with_views("""
SELECT event_id, event_time, event_type, product_id, category_id, category_code, brand, price, user_id, user_session
FROM (SELECT *, row_number() OVER (PARTITION BY event_type, product_id, price, user_id, user_session
                                   ORDER BY event_time, event_id) AS r
      FROM behavior WHERE event_type IN ('cart', 'purchase')) WHERE r = 1""", "behavior"))
def dedup_five_columns(spark, sf):
    return keep_first(targets(t.behavior(spark, sf)), TARGET_KEY, FIRST)


@query("d11_subset_counts", t.with_views("""
SELECT count(*) AS n_all, count(*) FILTER (event_type = 'cart') AS carts,
       count(*) FILTER (event_type = 'purchase') AS purchases, count(*) FILTER (brand IS NULL) AS no_brand
FROM behavior""", "behavior"))
def subset_counts(spark, sf):
    return t.behavior(spark, sf).agg(
        F.count(F.lit(1)).alias("n_all"), F.count_if(F.col("event_type") == "cart").alias("carts"),
        F.count_if(F.col("event_type") == "purchase").alias("purchases"),
        F.count_if(F.col("brand").isNull()).alias("no_brand"))


def _number_bins(column, source):
    return f"""
SELECT '{column}' AS column_name,
       CAST(least(floor(({column} - lo) / ((hi - lo) / 10)), 9) AS BIGINT) AS bin,
       CAST(NULL AS VARCHAR) AS value, count(*) AS n
FROM {source}, (SELECT CAST(min({column}) AS DOUBLE) AS lo, CAST(max({column}) AS DOUBLE) AS hi FROM {source})
WHERE {column} IS NOT NULL GROUP BY 2"""


@query("d15_histogram", t.with_views(
    _number_bins("price", "behavior") + " UNION ALL " + _number_bins("user_id", "behavior") + """
UNION ALL SELECT 'brand', NULL, brand, count(*) FROM behavior WHERE brand IS NOT NULL GROUP BY brand""",
    "behavior"))
def histograms(spark, sf):
    return histogram(t.behavior(spark, sf), ["price", "user_id", "brand"])
