"""Projections, filters and predicates."""

from pyspark.sql import functions as F

from cartflow.catalog.registry import query
from cartflow.functions.text import DEVICE_MAKERS, EMAIL_PROVIDER, email_provider, first_match, piece
from cartflow.operators.columns import dash_to_underscore, rare_to_others, split_identity
from cartflow.operators.labels import add_is_purchased, targets
from cartflow.plans.heavy import split_join
from cartflow.plans.training import TRAINING_COLUMNS, add_item_columns
from cartflow.sources import tables as t

ALL = "event_id, event_time, event_type, product_id, category_id, category_code, brand, price, user_id, user_session"


@query("b1_equality_filter", t.with_views(
    f"SELECT {ALL} FROM behavior WHERE event_type = 'purchase'", "behavior"))
def equality_filter(spark, sf):
    return t.behavior(spark, sf).where(F.col("event_type") == "purchase")


@query("b2_in_filter", t.with_views(
    f"SELECT {ALL} FROM behavior WHERE event_type IN ('cart', 'purchase')", "behavior"))
def in_filter(spark, sf):
    return targets(t.behavior(spark, sf))


@query("b3_not_null_filter", t.with_views(
    f"SELECT {ALL} FROM behavior WHERE category_code IS NOT NULL AND brand IS NOT NULL", "behavior"))
def not_null_filter(spark, sf):
    return t.behavior(spark, sf).na.drop(subset=["category_code", "brand"])


@query("b4_complete_rows", t.with_views("""
SELECT transaction_id, p_emaildomain, r_emaildomain FROM transactions
WHERE p_emaildomain IS NOT NULL AND r_emaildomain IS NOT NULL""", "transactions"))
def complete_rows(spark, sf):
    return t.transactions(spark, sf).na.drop("any").select(
        "transaction_id", "p_emaildomain", "r_emaildomain")


@query("b5_number_and_text_comparison", t.with_views("""
SELECT 'number' AS test, doc_id, doc, myid FROM times WHERE myid < 2
UNION ALL SELECT 'text', doc_id, doc, myid FROM times WHERE doc = 'V '""", "times"))
def comparisons(spark, sf):
    documents = t.times(spark, sf)
    kept = [documents.where(F.col("myid") < 2).select(F.lit("number").alias("test"), "doc_id", "doc", "myid"),
            documents.where(F.col("doc") == "V ").select(F.lit("text").alias("test"), "doc_id", "doc", "myid")]
    return kept[0].unionByName(kept[1])


@query("b6_sql_projection", t.with_views("""
SELECT myid, doc, timestamp_ FROM times WHERE myid > 6 AND doc = 'V '""", "times"))
def sql_projection(spark, sf):
    t.times(spark, sf).createOrReplaceTempView("documents_flat")
    return spark.sql("SELECT myid, doc, timestamp_ FROM documents_flat WHERE myid > 6 AND doc = 'V '")


@query("b7_select_star_limit", t.with_views("SELECT * FROM times ORDER BY timestamp_, doc_id LIMIT 10", "times"))
def select_star_limit(spark, sf):
    t.times(spark, sf).createOrReplaceTempView("documents_flat")
    return spark.sql("SELECT * FROM documents_flat ORDER BY timestamp_, doc_id").limit(10)


@query("b8_one_session", t.with_views(f"""
SELECT {ALL} FROM behavior WHERE user_session = '7-2024-01-01' ORDER BY event_time, event_id""", "behavior"))
def one_session(spark, sf):
    return (t.behavior(spark, sf).where(F.col("user_session") == "7-2024-01-01")
            .orderBy("event_time", "event_id"))


@query("b9_qualified_projection", t.with_views("""
SELECT a.event_id, a.user_session, a.product_id, b.sessions FROM behavior a
JOIN (SELECT product_id, count(DISTINCT user_session) AS sessions FROM behavior GROUP BY product_id) b
ON a.product_id = b.product_id WHERE a.event_type = 'cart'""", "behavior"))
def qualified_projection(spark, sf):
    events = t.behavior(spark, sf)
    per_product = events.groupBy("product_id").agg(F.count_distinct("user_session").alias("sessions"))
    carts = events.where(F.col("event_type") == "cart").select("event_id", "user_session", "product_id")
    return split_join(carts, per_product, ["product_id"], "inner").select("event_id", "user_session", "product_id", "sessions")


@query("b10_rename_columns", t.with_views("""
SELECT transaction_id, id_30, id_31, id_33, id_34, id_23, device_info AS device FROM identity_info""",
                                          "identity_info"))
def rename_columns(spark, sf):
    dashed = t.identity_info(spark, sf).withColumnsRenamed(
        {f"id_{n}": f"id-{n}" for n in (30, 31, 33, 34, 23)})
    return dash_to_underscore(dashed).withColumnsRenamed({"device_info": "device"})


@query("b11_drop_columns", t.with_views("""
SELECT event_id, event_type, product_id, price, user_id FROM behavior""", "behavior"))
def drop_columns(spark, sf):
    return t.behavior(spark, sf).drop("event_time", "category_id", "category_code", "brand", "user_session")


@query("b12_keep_list", t.with_views("""
SELECT price, CAST(extract(hour FROM event_time) AS BIGINT) AS dt_hour,
       CAST(extract(day FROM event_time) AS BIGINT) AS dt_day,
       CAST(dayofweek(event_time) + 1 AS BIGINT) AS week_day FROM behavior""", "behavior"))
def keep_list(spark, sf):
    items = add_item_columns(t.behavior(spark, sf))
    kept = items.select(*[c for c in items.columns
                          if c in TRAINING_COLUMNS and (c == "price" or c in ("dt_hour", "dt_day", "week_day"))])
    return kept.select("price", *[F.col(c).cast("bigint").alias(c) for c in ("dt_hour", "dt_day", "week_day")])


@query("b13_conditional_column", t.with_views("""
SELECT event_id, CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END AS is_purchased FROM behavior""",
                                              "behavior"))
def conditional_column(spark, sf):
    return add_is_purchased(t.behavior(spark, sf)).select("event_id", "is_purchased")


@query("b14_coalesce", t.with_views("""
SELECT event_id, coalesce(brand, category_code, 'none') AS brand_or_code FROM behavior""", "behavior"))
def coalesce(spark, sf):
    return t.behavior(spark, sf).select(
        "event_id", F.coalesce("brand", "category_code", F.lit("none")).alias("brand_or_code"))


@query("b15_cast", t.with_views("""
SELECT event_id, CAST(category_id AS VARCHAR) AS category_id, CAST(trunc(price) AS INT) AS price
FROM behavior""", "behavior"))
def cast(spark, sf):
    return t.behavior(spark, sf).select(
        "event_id", F.col("category_id").cast("string").alias("category_id"),
        F.col("price").cast("int").alias("price"))


@query("b16_fill_nulls", t.with_views("""
SELECT i.transaction_id, coalesce(t.is_fraud, 0) AS is_fraud, coalesce(i.id_30, '-999') AS id_30,
       coalesce(i.id_33, '-999') AS id_33
FROM identity_info i LEFT JOIN (SELECT * FROM transactions WHERE is_fraud = 1) t
ON i.transaction_id = t.transaction_id""", "identity_info", "transactions"))
def fill_nulls(spark, sf):
    fraud = t.transactions(spark, sf).where(F.col("is_fraud") == 1).select("transaction_id", "is_fraud")
    joined = t.identity_info(spark, sf).select("transaction_id", "id_30", "id_33").join(
        fraud, "transaction_id", "left")
    return joined.fillna(0, subset=["is_fraud"]).fillna("-999")


@query("b17_match_flag", t.with_views("""
SELECT t.transaction_id, i.had_id FROM transactions t
LEFT JOIN (SELECT transaction_id, 1 AS had_id FROM identity_info) i ON t.transaction_id = i.transaction_id""",
                                      "transactions", "identity_info"))
def match_flag(spark, sf):
    flagged = t.identity_info(spark, sf).select("transaction_id", F.lit(1).alias("had_id"))
    return t.transactions(spark, sf).select("transaction_id").join(flagged, "transaction_id", "left")


_PROVIDERS = ", ".join(f"('{k}', '{v}')" for k, v in EMAIL_PROVIDER.items())


@query("b18_dictionary_lookup", t.with_views(f"""
, m(domain, provider) AS (VALUES {_PROVIDERS})
SELECT transaction_id, p.provider AS p_bin, r.provider AS r_bin FROM transactions
LEFT JOIN m p ON p.domain = p_emaildomain LEFT JOIN m r ON r.domain = r_emaildomain""", "transactions"))
def dictionary_lookup(spark, sf):
    return t.transactions(spark, sf).select(
        "transaction_id", email_provider(F.col("p_emaildomain")).alias("p_bin"),
        email_provider(F.col("r_emaildomain")).alias("r_bin"))


_MAKER_CASES = " ".join(f"WHEN contains(raw_name, '{p}') THEN '{v}'" for p, v in DEVICE_MAKERS)
_DEVICE_SQL = f"""
, raw AS (SELECT *, string_split(device_info, '/')[1] AS raw_name FROM identity_info),
named AS (SELECT *, CASE {_MAKER_CASES} ELSE raw_name END AS maker FROM raw)"""


@query("b19_first_match_rewrite", t.with_views(
    f"{_DEVICE_SQL} SELECT transaction_id, maker AS device_name FROM named", "identity_info"))
def first_match_rewrite(spark, sf):
    return t.identity_info(spark, sf).select(
        "transaction_id", first_match(piece("device_info", "/", 0), DEVICE_MAKERS).alias("device_name"))


_RARE = "CASE WHEN maker IS NULL THEN NULL WHEN count(*) OVER (PARTITION BY maker) < 200 THEN 'Others' ELSE maker END"


@query("b20_rare_to_others", t.with_views(
    f"{_DEVICE_SQL} SELECT transaction_id, {_RARE} AS device_name FROM named", "identity_info"))
def rare_values(spark, sf):
    named = t.identity_info(spark, sf).select(
        "transaction_id", first_match(piece("device_info", "/", 0), DEVICE_MAKERS).alias("device_name"))
    return rare_to_others(named, "device_name")


@query("b19_b20_identity_split", t.with_views(f"""{_DEVICE_SQL}
SELECT transaction_id, device_info, id_30, id_31, id_33, string_split(id_34, ':')[2] AS id_34,
       string_split(id_23, ':')[2] AS id_23, {_RARE} AS device_name,
       string_split(device_info, '/')[2] AS device_version,
       string_split(id_30, ' ')[1] AS os_id_30, string_split(id_30, ' ')[2] AS version_id_30,
       string_split(id_31, ' ')[1] AS browser_id_31, string_split(id_31, ' ')[2] AS version_id_31,
       string_split(id_33, 'x')[1] AS screen_width, string_split(id_33, 'x')[2] AS screen_height,
       1 AS had_id FROM named""", "identity_info"))
def identity_split(spark, sf):
    return split_identity(t.identity_info(spark, sf))
