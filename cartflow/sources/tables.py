"""The supplied parquet tables and the shop-shaped views over them.

Each view exists twice: as a DataFrame for Spark, and as SQL text (``VIEW_SQL``) which an
independent engine runs as the oracle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartflow.plans.ordered import positions
from cartflow.session import materialise

# A visitor looks at an aisle of this many products; the aisles of all visitors cover the whole product table.
AISLE = 20


# Declared, so that building a plan reads no file.
SCHEMAS = {
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def products(part: DataFrame) -> DataFrame:
    """The product side of the shop: ids, category codes, brands and prices."""
    key = F.col("p_partkey")
    level2, level3 = (F.split_part("p_name", F.lit(" "), F.lit(i)) for i in (2, 1))
    stem = F.concat(F.lower("p_type"), F.lit("."), level2)
    return part.select(
        key.alias("product_id"),
        (F.lit(2053013552000000000) + key * F.lit(10000000003)).alias("category_id"),
        F.when(key % 5 == 0, None).when(key % 2 == 0, stem)
         .otherwise(F.concat(stem, F.lit("."), level3)).alias("category_code"),
        F.when(key % 7 != 0, F.lower("p_brand")).alias("brand"),
        F.col("p_retailprice").alias("price"))


def shop_events(events: DataFrame, part: DataFrame) -> DataFrame:
    """Shop events from raw events and the product table; works on a stream too.

    The number in ``props`` is a place in the visitor's aisle, counted on through the product table and around its end.
    Adaptive execution chooses the join by the measured size of the products.
    """
    products_in_all = part.count()
    week = F.date_trunc("week", "ts").cast("date").cast("string")
    rows = events.select(
        "event_id", F.col("ts").alias("event_time"),
        F.when(F.col("event_type") == "purchase", "purchase")
         .when(F.col("event_type") == "click", "cart").otherwise("view").alias("event_type"),
        ((F.regexp_extract("props", "([0-9]+)", 1).cast("bigint") % AISLE + F.col("user_id") * AISLE)
         % products_in_all).alias("product_id"),
        "user_id",
        F.concat(F.col("user_id").cast("string"), F.lit("-"), week).alias("user_session"))
    return rows.join(products(part), "product_id").select(
        "event_id", "event_time", "event_type", "product_id", "category_id", "category_code",
        "brand", "price", "user_id", "user_session")


def behavior(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shop_events(table(spark, sf_dir, "events"), table(spark, sf_dir, "part"))


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    key, customer, date = F.col("o_orderkey"), F.col("o_custkey") % 8, F.col("o_orderdate")
    domain = F.when(customer == 0, "gmail.com")
    for i, text in enumerate(["yahoo.com", "hotmail.fr", "gmail", "comcast.net", "scranton.edu",
                              "unmapped.org"], start=1):
        domain = domain.when(customer == i, text)
    days = F.year(date) * 372 + F.month(date) * 31 + F.dayofmonth(date)
    return table(spark, sf_dir, "orders").select(
        key.alias("transaction_id"),
        F.when(F.col("o_orderstatus") == "F", 1).otherwise(0).alias("is_fraud"),
        (days.cast("bigint") * 86400).alias("transaction_dt"),
        F.col("o_totalprice").alias("transaction_amt"),
        domain.alias("p_emaildomain"),
        F.when(key % 12 == 0, "icloud.com").alias("r_emaildomain"),
        F.lit("x").alias("constant_col"),
        F.when(key % 25 == 0, "rare").otherwise("main").alias("dominant_col"))


def _cases(column, values: dict[int, str], otherwise: str | None):
    items = list(values.items())
    result = F.when(column == items[0][0], items[0][1])
    for number, text in items[1:]:
        result = result.when(column == number, text)
    return result.otherwise(F.lit(otherwise).cast("string"))


def identity_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("o_orderkey")
    device = F.when(key % 32 != 24, _cases(key % 32, {
        0: "SM-G935F Build/NRD90M", 4: "Moto G (4) Build/NPJ25", 8: "rv:57.0",
        12: "LG-M150 Build/MXB48T", 16: "ALE-L23 Build/HUAWEI", 20: "Windows",
    }, "XT1635-02 Build/NPN26"))
    return table(spark, sf_dir, "orders").where(key % 4 == 0).select(
        key.alias("transaction_id"),
        F.when(key % 1000 == 0, "Hisense U601 Build/A1").otherwise(device).alias("device_info"),
        _cases(key % 16, {0: "Windows 10", 4: "iOS 11.1.2", 8: "Android 7.0"}, None).alias("id_30"),
        _cases(key % 16, {0: "chrome 62.0", 4: "mobile safari 11.0"}, "edge").alias("id_31"),
        _cases(key % 12, {0: "1920x1080", 4: "2220x1080"}, None).alias("id_33"),
        F.when(key % 8 == 0, "match_status:2").otherwise("match_status:1").alias("id_34"),
        F.when(key % 3 == 0, "IP_PROXY:TRANSPARENT").alias("id_23"))


def times(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        F.col("event_id").alias("doc_id"),
        F.concat(F.upper(F.substring("event_type", 1, 1)), F.lit(" ")).alias("doc"),
        F.col("ts").alias("timestamp_"),
        (F.col("user_id") % 9).cast("double").alias("myid"))


def metric_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counters that restart every 50 samples of a series; stored, as samples would be."""
    samples = table(spark, sf_dir, "events").select(
        "ts", "event_id", F.lit("messages_in").alias("metric"), F.col("event_type").alias("topic"),
        (F.col("user_id") % 2).alias("instance"))
    numbered = positions(samples, ["ts", "event_id"], "_n", group=["topic", "instance"])
    return materialise(numbered.select("ts", "metric", "topic", "instance",
                                       (F.col("_n") % 50).cast("double").alias("value")))


def scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    bought = F.col("event_type") == "purchase"
    points = F.col("event_id") * 7919 % 101 + F.when(bought, 20).otherwise(0)
    return table(spark, sf_dir, "events").select(
        "event_id", F.when(bought, 1).otherwise(0).alias("label"),
        (points.cast("double") / 121).alias("score"),
        F.when(points >= 61, 1).otherwise(0).alias("prediction"))


VIEW_SQL = {
    "behavior": """
SELECT e.event_id,
       e.ts AS event_time,
       CASE WHEN e.event_type = 'purchase' THEN 'purchase'
            WHEN e.event_type = 'click' THEN 'cart' ELSE 'view' END AS event_type,
       p.p_partkey AS product_id,
       2053013552000000000 + p.p_partkey * 10000000003 AS category_id,
       CASE WHEN p.p_partkey % 5 = 0 THEN NULL
            WHEN p.p_partkey % 2 = 0 THEN lower(p.p_type) || '.' || split_part(p.p_name, ' ', 2)
            ELSE lower(p.p_type) || '.' || split_part(p.p_name, ' ', 2) || '.' || split_part(p.p_name, ' ', 1)
       END AS category_code,
       CASE WHEN p.p_partkey % 7 = 0 THEN NULL ELSE lower(p.p_brand) END AS brand,
       p.p_retailprice AS price,
       e.user_id AS user_id,
       CAST(e.user_id AS VARCHAR(20)) || '-' ||
         CAST(CAST(date_trunc('week', e.ts) AS DATE) AS VARCHAR(20)) AS user_session
FROM events e
JOIN part p ON p.p_partkey = (CAST(regexp_extract(e.props, '([0-9]+)', 1) AS BIGINT) % 20 + e.user_id * 20)
                             % (SELECT count(*) FROM part)""",
    "transactions": """
SELECT o_orderkey AS transaction_id,
       CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS is_fraud,
       CAST(extract(YEAR FROM o_orderdate) * 372 + extract(MONTH FROM o_orderdate) * 31
            + extract(DAY FROM o_orderdate) AS BIGINT) * 86400 AS transaction_dt,
       o_totalprice AS transaction_amt,
       CASE o_custkey % 8 WHEN 0 THEN 'gmail.com' WHEN 1 THEN 'yahoo.com' WHEN 2 THEN 'hotmail.fr'
            WHEN 3 THEN 'gmail' WHEN 4 THEN 'comcast.net' WHEN 5 THEN 'scranton.edu'
            WHEN 6 THEN 'unmapped.org' ELSE NULL END AS p_emaildomain,
       CASE WHEN o_orderkey % 12 = 0 THEN 'icloud.com' ELSE NULL END AS r_emaildomain,
       'x' AS constant_col,
       CASE WHEN o_orderkey % 25 = 0 THEN 'rare' ELSE 'main' END AS dominant_col
FROM orders""",
    "identity_info": """
SELECT o_orderkey AS transaction_id,
       CASE WHEN o_orderkey % 1000 = 0 THEN 'Hisense U601 Build/A1'
            ELSE CASE o_orderkey % 32 WHEN 0 THEN 'SM-G935F Build/NRD90M' WHEN 4 THEN 'Moto G (4) Build/NPJ25'
              WHEN 8 THEN 'rv:57.0' WHEN 12 THEN 'LG-M150 Build/MXB48T' WHEN 16 THEN 'ALE-L23 Build/HUAWEI'
              WHEN 20 THEN 'Windows' WHEN 24 THEN NULL ELSE 'XT1635-02 Build/NPN26' END
       END AS device_info,
       CASE o_orderkey % 16 WHEN 0 THEN 'Windows 10' WHEN 4 THEN 'iOS 11.1.2' WHEN 8 THEN 'Android 7.0' ELSE NULL END AS id_30,
       CASE o_orderkey % 16 WHEN 0 THEN 'chrome 62.0' WHEN 4 THEN 'mobile safari 11.0' ELSE 'edge' END AS id_31,
       CASE o_orderkey % 12 WHEN 0 THEN '1920x1080' WHEN 4 THEN '2220x1080' ELSE NULL END AS id_33,
       CASE WHEN o_orderkey % 8 = 0 THEN 'match_status:2' ELSE 'match_status:1' END AS id_34,
       CASE WHEN o_orderkey % 3 = 0 THEN 'IP_PROXY:TRANSPARENT' ELSE NULL END AS id_23
FROM orders WHERE o_orderkey % 4 = 0""",
    "times": """
SELECT event_id AS doc_id, upper(substring(event_type, 1, 1)) || ' ' AS doc, ts AS timestamp_,
       CAST(user_id % 9 AS DOUBLE) AS myid
FROM events""",
    "metric_samples": """
SELECT ts, 'messages_in' AS metric, event_type AS topic, user_id % 2 AS instance,
       CAST(row_number() OVER (PARTITION BY event_type, user_id % 2 ORDER BY ts, event_id) % 50 AS DOUBLE) AS value
FROM events""",
    "scores": """
SELECT event_id,
       CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END AS label,
       CAST(event_id * 7919 % 101 + CASE WHEN event_type = 'purchase' THEN 20 ELSE 0 END AS DOUBLE) / 121 AS score,
       CASE WHEN event_id * 7919 % 101 + CASE WHEN event_type = 'purchase' THEN 20 ELSE 0 END >= 61 THEN 1 ELSE 0 END AS prediction
FROM events""",
}


def with_views(sql: str, *names: str) -> str:
    """Oracle SQL whose ``WITH`` clause defines the named views from the base tables.

    ``sql`` is the rest of the statement, or starts with ``, name AS (...)`` to add
    named steps of its own.
    """
    clause = ",\n".join(f"{name} AS ({VIEW_SQL[name]})" for name in names)
    return f"WITH {clause}\n{sql.strip()}"
