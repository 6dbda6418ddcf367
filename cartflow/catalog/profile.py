"""Column profiles and type narrowing."""

from pyspark.sql import functions as F

from cartflow.catalog.registry import query
from cartflow.operators import profile as p
from cartflow.sources import tables as t

COLUMNS = ["transaction_id", "is_fraud", "transaction_dt", "transaction_amt", "p_emaildomain",
           "r_emaildomain", "constant_col", "dominant_col"]


def _per_column(template: str) -> str:
    return " UNION ALL ".join(template.format(c=c) for c in COLUMNS)


@query("d12_constant_columns", t.with_views(_per_column(
    "SELECT '{c}' AS column_name, count(DISTINCT {c}) <= 1 AS is_constant FROM transactions"), "transactions"))
def constant_columns(spark, sf):
    return p.constant_columns(t.transactions(spark, sf))


@query("d13_null_ratios", t.with_views(_per_column(
    "SELECT '{c}' AS column_name, round(avg(CASE WHEN {c} IS NULL THEN 1.0 ELSE 0.0 END), 6) AS null_ratio, "
    "avg(CASE WHEN {c} IS NULL THEN 1.0 ELSE 0.0 END) > 0.9 AS mostly_null FROM transactions"), "transactions"))
def null_ratios(spark, sf):
    return p.null_ratios(t.transactions(spark, sf)).withColumn("null_ratio", F.round("null_ratio", 6))


_TOP = "(SELECT count(*) AS n FROM transactions GROUP BY {c})"


@query("d14_dominant_values", t.with_views(_per_column(
    "SELECT '{c}' AS column_name, round(max(n) / sum(n), 6) AS top_ratio, "
    f"max(n) / sum(n) > 0.9 AS is_dominated FROM {_TOP}"), "transactions"))
def dominant_values(spark, sf):
    return p.dominant_values(t.transactions(spark, sf)).withColumn("top_ratio", F.round("top_ratio", 6))


@query("d14_dominant_values_at_a_low_limit", t.with_views(_per_column(
    "SELECT '{c}' AS column_name, round(max(n) / sum(n), 6) AS top_ratio, "
    f"max(n) / sum(n) > 0.1 AS is_dominated FROM {_TOP}"), "transactions"))
def dominant_values_low(spark, sf):
    return p.dominant_values(t.transactions(spark, sf), limit=0.1).withColumn("top_ratio", F.round("top_ratio", 6))


_PROFILE = _per_column(
    "SELECT '{c}' AS column_name, count(DISTINCT {c}) AS n_distinct, "
    "avg(CASE WHEN {c} IS NULL THEN 1.0 ELSE 0.0 END) AS null_ratio, "
    f"(SELECT max(n) / sum(n) FROM {_TOP}) AS top_ratio FROM transactions")


@query("d12_d14_column_profile", t.with_views(f"""
, profile AS ({_PROFILE})
SELECT column_name, n_distinct, round(null_ratio, 6) AS null_ratio, round(top_ratio, 6) AS top_ratio,
       n_distinct <= 1 OR null_ratio > 0.9 OR top_ratio > 0.9 AS "drop" FROM profile""", "transactions"))
def column_profile(spark, sf):
    return p.column_profile(t.transactions(spark, sf)).withColumns(
        {c: F.round(c, 6) for c in ("null_ratio", "top_ratio")})


@query("d16_drop_useless_columns", t.with_views("""
SELECT transaction_id, is_fraud, transaction_dt, transaction_amt, p_emaildomain FROM transactions""",
                                                "transactions"))
def drop_useless_columns(spark, sf):
    table = t.transactions(spark, sf)
    parts = [table.where(F.col("is_fraud") == 0), table.where(F.col("is_fraud") == 1)]
    kept = p.useless_columns(parts, protect=["is_fraud"])
    return table.drop(*kept)


@query("d17_type_narrowing_report", t.with_views("""
, r AS (SELECT min(transaction_id) AS k_lo, max(transaction_id) AS k_hi, min(transaction_dt) AS d_lo,
               max(transaction_dt) AS d_hi, min(is_fraud) AS f_lo, max(is_fraud) AS f_hi FROM transactions),
c(column_name, from_type, lo, hi) AS (
  SELECT 'transaction_id', 'bigint', k_lo, k_hi FROM r UNION ALL SELECT 'is_fraud', 'int', f_lo, f_hi FROM r
  UNION ALL SELECT 'transaction_dt', 'bigint', d_lo, d_hi FROM r)
SELECT column_name, from_type, CASE WHEN lo > -128 AND hi < 127 THEN 'tinyint'
  WHEN lo > -32768 AND hi < 32767 THEN 'smallint'
  WHEN lo > -2147483648 AND hi < 2147483647 THEN 'int' ELSE 'bigint' END AS to_type FROM c
UNION ALL SELECT 'transaction_amt', 'double', 'float'""", "transactions"))
def narrowing_report(spark, sf):
    return p.narrow_types(t.transactions(spark, sf))[1]


@query("d17_narrowed_table", t.with_views("""
SELECT transaction_id, is_fraud, round(CAST(CAST(transaction_amt AS FLOAT) AS DOUBLE), 2) AS transaction_amt
FROM transactions""", "transactions"))
def narrowed_table(spark, sf):
    narrowed = p.narrow_types(t.transactions(spark, sf).select("transaction_id", "is_fraud", "transaction_amt"))[0]
    return narrowed.select(F.col("transaction_id").cast("bigint").alias("transaction_id"),
                           F.col("is_fraud").cast("int").alias("is_fraud"),
                           F.round(F.col("transaction_amt").cast("double"), 2).alias("transaction_amt"))
