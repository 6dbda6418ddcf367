"""Feature engineering."""

from pyspark.ml.feature import OneHotEncoder, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from cartflow.catalog.registry import query
from cartflow.catalog.sampling import _bits
from cartflow.catalog.training import STEPS
from cartflow.operators import features as f
from cartflow.operators import target_codes
from cartflow.operators.indexing import TableIndexer, TableIndexModel
from cartflow.operators.models import sized_for_fits
from cartflow.operators.sampling import hash_edge, random_folds
from cartflow.plans.training import add_category_levels, carted_items, training_table
from cartflow.session import work_folder
from cartflow.sources import tables as t


@query("p1_index_by_frequency", t.with_views("""
, b AS (SELECT brand AS value, row_number() OVER (ORDER BY count(*) DESC, brand) - 1 AS code
        FROM behavior WHERE brand IS NOT NULL GROUP BY brand),
c AS (SELECT category_code AS value, row_number() OVER (ORDER BY count(*) DESC, category_code) - 1 AS code
      FROM behavior WHERE category_code IS NOT NULL GROUP BY category_code)
SELECT event_id, b.code AS brand_index, c.code AS category_code_index FROM behavior
LEFT JOIN b ON b.value = brand LEFT JOIN c ON c.value = category_code""", "behavior"))
def index_by_frequency(spark, sf):
    events, columns = t.behavior(spark, sf), ["brand", "category_code"]
    codes = f.value_codes([events], columns, by="frequency")
    return f.index_values(events.select("event_id", *columns), codes, columns).select(
        "event_id", "brand_index", "category_code_index")


@query("p2_label", t.with_views("""
SELECT event_id, CAST(CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END AS DOUBLE) AS label FROM behavior""",
                                "behavior"))
def label(spark, sf):
    flagged = t.behavior(spark, sf).select(
        "event_id", F.when(F.col("event_type") == "purchase", 1).otherwise(0).alias("is_purchased"))
    return f.with_label(flagged).select("event_id", "label")


@query("p3_alphabetical_codes", t.with_views("""
SELECT event_id, dense_rank() OVER (ORDER BY brand) - 1 AS brand_code,
       dense_rank() OVER (ORDER BY event_type) - 1 AS event_type_code
FROM behavior WHERE brand IS NOT NULL""", "behavior"))
def alphabetical_codes(spark, sf):
    events, columns = t.behavior(spark, sf).where(F.col("brand").isNotNull()), ["brand", "event_type"]
    codes = f.value_codes([events], columns)
    return f.index_values(events.select("event_id", *columns), codes, columns, suffix="_code").select(
        "event_id", "brand_code", "event_type_code")


@query("p4_shared_codes_train_and_test", t.with_views("""
, shared AS (SELECT coalesce(p_emaildomain, 'nan') AS v FROM transactions
           UNION ALL SELECT coalesce(device_info, 'nan') FROM identity_info),
m AS (SELECT v, row_number() OVER (ORDER BY v) - 1 AS code FROM (SELECT DISTINCT v FROM shared))
SELECT transaction_id, code AS domain_code FROM transactions JOIN m ON v = coalesce(p_emaildomain, 'nan')""",
                                                      "transactions", "identity_info"))
def shared_codes(spark, sf):
    train = t.transactions(spark, sf).select("transaction_id", F.col("p_emaildomain").alias("domain"))
    test = t.identity_info(spark, sf).select("transaction_id", F.col("device_info").alias("domain"))
    codes = f.value_codes([train, test], ["domain"], null_text="nan")
    return f.index_values(train, codes, ["domain"], suffix="_code", null_text="nan").select(
        "transaction_id", "domain_code")


def _time_parts(spark, sf):
    return t.behavior(spark, sf).select("event_id", F.dayofweek("event_time").alias("week_day"),
                                        F.hour("event_time").alias("dt_hour"))


@query("p5_one_hot", t.with_views("""
SELECT event_id, CAST(max(dayofweek(event_time) + 1) OVER () AS BIGINT) AS size,
       CASE WHEN dayofweek(event_time) + 1 < max(dayofweek(event_time) + 1) OVER ()
            THEN CAST(dayofweek(event_time) + 1 AS BIGINT) END AS active FROM behavior""", "behavior"))
def one_hot(spark, sf):
    # The last value has no entry of its own, so it is the vector of zeros.
    parts = _time_parts(spark, sf)
    encoder = OneHotEncoder(inputCols=["week_day"], outputCols=["coded"])
    bits = vector_to_array("coded")
    return encoder.fit(parts).transform(parts).select(
        "event_id", F.size(bits).cast("bigint").alias("size"),
        F.nullif(F.array_position(bits, F.lit(1.0)) - 1, F.lit(-1)).cast("bigint").alias("active"))


@query("p6_assembled_vector", t.with_views("""
SELECT event_id, price AS v0, CAST(dayofweek(event_time) + 1 AS DOUBLE) AS v1,
       CAST(extract(hour FROM event_time) AS DOUBLE) AS v2 FROM behavior""", "behavior"))
def assembled_vector(spark, sf):
    parts = _time_parts(spark, sf).join(t.behavior(spark, sf).select("event_id", "price"), "event_id")
    assembler = VectorAssembler(inputCols=["price", "week_day", "dt_hour"], outputCol="features")
    vector = vector_to_array("features")
    return assembler.transform(parts).select("event_id", *[vector[i].alias(f"v{i}") for i in range(3)])


@query("p7_scale_to_unit_deviation", t.with_views("""
, s AS (SELECT stddev_samp(price) AS d FROM behavior)
SELECT event_id, round(price / d, 6) AS price_scaled FROM behavior, s""", "behavior"))
def scaled(spark, sf):
    return f.scale_to_unit_deviation(t.behavior(spark, sf), ["price"]).select(
        "event_id", F.round("price_scaled", 6).alias("price_scaled"))


@query("p8_feature_stages", t.with_views(f"""{STEPS}
SELECT CAST(bought AS DOUBLE) AS label, count(*) AS n,
       CAST(max(max(dayofweek(event_time) + 1)) OVER () + max(max(extract(day FROM event_time))) OVER ()
            + max(max(extract(hour FROM event_time))) OVER () + 9 AS BIGINT) AS features_size
FROM c GROUP BY bought""", "behavior"))
def feature_stages(spark, sf):
    table = sized_for_fits(f.with_label(training_table(t.behavior(spark, sf), keep=["event_id"])), "event_id")
    fitted = f.fit_features(table)
    size = F.size(vector_to_array("features"))
    return fitted.transform(table).groupBy("label", size.cast("bigint").alias("features_size")).agg(
        F.count(F.lit(1)).alias("n"))


@query("p8_table_index_saved_and_reloaded", t.with_views("""
, v AS (SELECT user_session AS value, row_number() OVER (ORDER BY count(*) DESC, user_session) - 1 AS code
        FROM behavior WHERE event_type = 'cart' GROUP BY user_session),
k AS (SELECT count(*) AS n FROM v)
SELECT event_id, CAST(coalesce(v.code, k.n) AS DOUBLE) AS session_index
FROM behavior b LEFT JOIN v ON v.value = b.user_session, k""", "behavior"))
def table_index_saved_and_reloaded(spark, sf):
    events, path = t.behavior(spark, sf), work_folder(spark, "model")
    indexer = TableIndexer(inputCols=["user_session"], outputCols=["session_index"])
    indexer.fit(events.where(F.col("event_type") == "cart")).save(path)
    return TableIndexModel.load(path).transform(events).select("event_id", "session_index")


@query("p9_model_columns", t.with_views("""
, f AS (SELECT event_id, string_split(category_code, '.')[1] AS level1 FROM behavior WHERE event_type = 'cart')
SELECT event_id, level1 AS category_code_level1 FROM f""", "behavior"))
def model_columns(spark, sf):
    carts = t.behavior(spark, sf).where(F.col("event_type") == "cart")
    return add_category_levels(carts).select("event_id", "category_code_level1")


@query("p9_indexed_training_rows", t.with_views("""
, c AS (SELECT event_id, brand FROM (SELECT *, row_number() OVER (
          PARTITION BY user_session, product_id ORDER BY event_time, event_id) AS r
        FROM behavior WHERE event_type = 'cart') WHERE r = 1),
b AS (SELECT brand AS value, row_number() OVER (ORDER BY count(*) DESC, brand) - 1 AS code
      FROM c WHERE brand IS NOT NULL GROUP BY brand)
SELECT event_id, code AS brand FROM c LEFT JOIN b ON b.value = c.brand""", "behavior"))
def indexed_training_rows(spark, sf):
    items = carted_items(t.behavior(spark, sf)).select("event_id", "brand")
    codes = f.value_codes([items], ["brand"], by="frequency")
    return f.index_values(items, codes, ["brand"]).select("event_id", F.col("brand_index").alias("brand"))


_FOLD = "CASE " + " ".join(f"WHEN {_bits('event_id', 7)} < {hash_edge((i + 1) / 5)} THEN {i}" for i in range(4)) + " ELSE 4 END"


@query("p8_out_of_fold_rates", t.with_views(f"""
, r AS (SELECT event_id, CAST(product_id AS VARCHAR) AS p, coalesce('=' || brand, 'null') AS b,
               CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END AS y, {_FOLD} AS fold FROM behavior),
f AS (SELECT fold, (SELECT sum(y) FROM r) - sum(y) AS s, (SELECT count(*) FROM r) - count(*) AS n FROM r GROUP BY fold),
p AS (SELECT p, sum(y) AS s, count(*) AS n FROM r GROUP BY p), pf AS (SELECT p, fold, sum(y) AS s, count(*) AS n FROM r GROUP BY p, fold),
b AS (SELECT b, sum(y) AS s, count(*) AS n FROM r GROUP BY b), bf AS (SELECT b, fold, sum(y) AS s, count(*) AS n FROM r GROUP BY b, fold)
SELECT event_id,
       round((p.s - pf.s + CAST(20 AS DOUBLE) * (CAST(f.s AS DOUBLE) / f.n)) / (p.n - pf.n + 20), 9) AS product_id_rate,
       round((b.s - bf.s + CAST(20 AS DOUBLE) * (CAST(f.s AS DOUBLE) / f.n)) / (b.n - bf.n + 20), 9) AS brand_rate
FROM r JOIN f USING (fold) JOIN p USING (p) JOIN pf USING (p, fold) JOIN b USING (b) JOIN bf USING (b, fold)""", "behavior"))
def out_of_fold_rates(spark, sf):
    events = t.behavior(spark, sf).select("event_id", "product_id", "brand", (F.col("event_type") == "purchase").cast("int").alias("y"))
    rows = random_folds(events, 5, "event_id", 7)
    found = target_codes.learn(rows, ["product_id", "brand"], "y", "fold").out_of_fold(rows, "fold")
    return found.select("event_id", *[F.round(c, 9).alias(c) for c in ("product_id_rate", "brand_rate")])
