"""Scalar functions."""

from pyspark.sql import functions as F

from cartflow.catalog.registry import query
from cartflow.functions.numeric import natural_log, thousandths
from cartflow.functions.text import email_suffix, piece
from cartflow.functions.time import day_from_text, weekday_monday_first_text, weekday_sunday_first
from cartflow.operators.columns import add_transaction_features
from cartflow.sources import tables as t


@query("h1_split_pieces", t.with_views("""
SELECT event_id, string_split(category_code, '.')[1] AS level1, string_split(category_code, '.')[2] AS level2,
       string_split(category_code, '.')[3] AS level4 FROM behavior""", "behavior"))
def split_pieces(spark, sf):
    return t.behavior(spark, sf).select(
        "event_id", *[piece("category_code", ".", i).alias(n)
                      for i, n in enumerate(("level1", "level2", "level4"))])


@query("h2_substring", t.with_views("""
SELECT event_id, substring(CAST(category_id AS VARCHAR), 1, 6) AS id1,
       substring(CAST(category_id AS VARCHAR), 7, 6) AS id2,
       substring(CAST(category_id AS VARCHAR), 13, 7) AS id3 FROM behavior""", "behavior"))
def substrings(spark, sf):
    text = F.col("category_id").cast("string")
    return t.behavior(spark, sf).select("event_id", *[
        F.substring(text, start, length).alias(name)
        for name, start, length in (("id1", 1, 6), ("id2", 7, 6), ("id3", 13, 7))])


@query("h3_day_of_time_text", t.with_views("""
SELECT event_id, CAST(event_time AS DATE) AS event_date FROM behavior""", "behavior"))
def day_of_time_text(spark, sf):
    return t.behavior(spark, sf).select("event_id", day_from_text(F.col("event_time")).alias("event_date"))


@query("h4_parse_day", """
SELECT o_orderkey, CAST(o_orderdate AS DATE) AS order_date FROM orders""")
def parse_day(spark, sf):
    text = F.date_format("o_orderdate", "yyyy-MM-dd")
    return t.table(spark, sf, "orders").select("o_orderkey", F.to_date(text, "yyyy-MM-dd").alias("order_date"))


@query("h5_h8_time_parts", t.with_views("""
SELECT event_id, CAST(dayofweek(event_time) + 1 AS BIGINT) AS week_day,
       CAST(isodow(event_time) - 1 AS VARCHAR) AS event_weekday,
       CAST(extract(hour FROM event_time) AS BIGINT) AS dt_hour,
       CAST(extract(day FROM event_time) AS BIGINT) AS dt_day FROM behavior""", "behavior"))
def time_parts(spark, sf):
    return t.behavior(spark, sf).select(
        "event_id", weekday_sunday_first("event_time").cast("bigint").alias("week_day"),
        weekday_monday_first_text("event_time").alias("event_weekday"),
        F.hour("event_time").cast("bigint").alias("dt_hour"),
        F.dayofmonth("event_time").cast("bigint").alias("dt_day"))


@query("h6_weekday_as_text", t.with_views("""
SELECT event_id, CAST(isodow(event_time) - 1 AS VARCHAR) AS event_weekday FROM behavior""", "behavior"))
def weekday_text(spark, sf):
    return t.behavior(spark, sf).select("event_id", weekday_monday_first_text("event_time").alias("event_weekday"))


@query("h7_events_per_hour", t.with_views("""
SELECT CAST(extract(hour FROM event_time) AS BIGINT) AS dt_hour, count(*) AS n FROM behavior GROUP BY 1""",
                                          "behavior"))
def events_per_hour(spark, sf):
    return (t.behavior(spark, sf).groupBy(F.hour("event_time").cast("bigint").alias("dt_hour"))
            .agg(F.count(F.lit(1)).alias("n")))


@query("h8_events_per_day_of_month", t.with_views("""
SELECT CAST(extract(day FROM event_time) AS BIGINT) AS dt_day, count(*) AS n FROM behavior GROUP BY 1""",
                                                  "behavior"))
def events_per_day_of_month(spark, sf):
    return (t.behavior(spark, sf).groupBy(F.dayofmonth("event_time").cast("bigint").alias("dt_day"))
            .agg(F.count(F.lit(1)).alias("n")))


@query("h9_contains", t.with_views("""
SELECT transaction_id, contains(device_info, 'Moto') AS upper_case, contains(device_info, 'moto') AS lower_case
FROM identity_info""", "identity_info"))
def contains(spark, sf):
    device = F.col("device_info")
    return t.identity_info(spark, sf).select(
        "transaction_id", device.contains("Moto").alias("upper_case"), device.contains("moto").alias("lower_case"))


_SUFFIX = """CASE WHEN split_part({c}, '.', -1) IN ('gmail', 'net', 'edu') THEN 'us'
            ELSE split_part({c}, '.', -1) END"""


@query("h10_email_suffix", t.with_views(f"""
SELECT transaction_id, {_SUFFIX.format(c='p_emaildomain')} AS p_suffix,
       {_SUFFIX.format(c='r_emaildomain')} AS r_suffix FROM transactions""", "transactions"))
def email_suffixes(spark, sf):
    return t.transactions(spark, sf).select(
        "transaction_id", email_suffix(F.col("p_emaildomain")).alias("p_suffix"),
        email_suffix(F.col("r_emaildomain")).alias("r_suffix"))


@query("h11_natural_log", t.with_views("""
SELECT transaction_id, round(ln(transaction_amt), 6) AS amount_log FROM transactions""", "transactions"))
def logs(spark, sf):
    return t.transactions(spark, sf).select(
        "transaction_id", F.round(natural_log("transaction_amt"), 6).alias("amount_log"))


@query("h12_thousandths", t.with_views("""
SELECT transaction_id,
       CAST(trunc((transaction_amt - CAST(trunc(transaction_amt) AS BIGINT)) * 1000) AS INT) AS amount_decimal
FROM transactions""", "transactions"))
def decimals(spark, sf):
    return t.transactions(spark, sf).select(
        "transaction_id", thousandths(F.col("transaction_amt")).alias("amount_decimal"))


@query("h10_h12_transaction_features", t.with_views(f"""
SELECT transaction_id, {_SUFFIX.format(c='p_emaildomain')} AS p_emaildomain_suffix,
       round(ln(transaction_amt), 6) AS transaction_amt_log,
       CAST(trunc((transaction_amt - CAST(trunc(transaction_amt) AS BIGINT)) * 1000) AS INT) AS transaction_amt_decimal
FROM transactions""", "transactions"))
def transaction_features(spark, sf):
    return add_transaction_features(t.transactions(spark, sf)).select(
        "transaction_id", "p_emaildomain_suffix", F.round("transaction_amt_log", 6).alias("transaction_amt_log"),
        "transaction_amt_decimal")


@query("h13_nested_field_and_parse", """
SELECT event_id, CAST(regexp_extract(props, '([0-9]+)', 1) AS INT) AS k, ts AS parsed FROM events""")
def nested_field_and_parse(spark, sf):
    fields = F.from_json("props", "k string").alias("p")
    return t.table(spark, sf, "events").select("event_id", "ts", fields).select(
        "event_id", F.col("p.k").cast("int").alias("k"),
        F.to_timestamp_ntz(F.col("ts").cast("string")).alias("parsed"))


@query("h14_array_explode", """
SELECT event_id, unnest([event_type, 'x']) AS element FROM events""")
def array_explode(spark, sf):
    return t.table(spark, sf, "events").select(
        "event_id", F.explode(F.array("event_type", F.lit("x"))).alias("element"))
