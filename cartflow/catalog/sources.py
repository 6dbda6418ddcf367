"""Sources, sinks and actions."""

from pyspark.sql import functions as F

from cartflow.catalog.registry import query
from cartflow.operators.explore import table_summary
from cartflow.schemas import EVENTS
from cartflow.session import work_folder
from cartflow.sources import tables as t
from cartflow.sources.collections import Collections
from cartflow.sources.files import read_csv, read_extended_json, write_csv, write_events
from cartflow.sources.snapshots import AlreadyThere, Snapshots

EVENT_COLUMNS = EVENTS.fieldNames()
NINE = ", ".join(EVENT_COLUMNS)


@query("a1_csv_scan", t.with_views(f"SELECT {NINE} FROM behavior", "behavior"))
def csv_scan(spark, sf):
    path = work_folder(spark, "csv")
    write_csv(t.behavior(spark, sf).select(EVENT_COLUMNS), path)
    return read_csv(spark, path)


@query("a2_csv_several_files", t.with_views("""
SELECT event_type, count(*) AS n, round(sum(price), 2) AS price_sum FROM behavior
GROUP BY event_type""", "behavior"))
def csv_several_files(spark, sf):
    paths = []
    events = t.behavior(spark, sf).select(EVENT_COLUMNS)
    for kind in ("view", "cart", "purchase"):
        paths.append(work_folder(spark, f"csv-{kind}"))
        write_csv(events.where(F.col("event_type") == kind), paths[-1])
    return read_csv(spark, paths).groupBy("event_type").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum("price"), 2).alias("price_sum"))


@query("a3_csv_drop_malformed", """
SELECT c_custkey AS country, c_acctbal AS population FROM customer WHERE c_custkey % 7 <> 0""")
def csv_drop_malformed(spark, sf):
    # Every seventh line carries a text where the number belongs.
    path = work_folder(spark, "malformed")
    write_csv(t.table(spark, sf, "customer").select(
        F.col("c_custkey").alias("country"),
        F.when(F.col("c_custkey") % 7 == 0, "n/a").otherwise(F.col("c_acctbal").cast("string"))
         .alias("population")), path)
    return read_csv(spark, path, "country bigint, population double", drop_malformed=True)


def _brand_counts(spark, sf):
    return (t.behavior(spark, sf).where(F.col("brand").isNotNull()).groupBy("brand")
            .agg(F.count(F.lit(1)).alias("n")))


BRAND_COUNTS = "SELECT brand, count(*) AS n FROM behavior WHERE brand IS NOT NULL GROUP BY brand"


def _store(spark):
    return Collections(spark, work_folder(spark, "collections"))


@query("a4_read_collection", t.with_views(BRAND_COUNTS, "behavior"))
def read_collection(spark, sf):
    store = _store(spark)
    store.write(_brand_counts(spark, sf), "shop", "brandcounts")
    return store.read("shop", "brandcounts")


@query("a5_earliest_document_per_key", t.with_views("""
SELECT doc, timestamp_ AS event_time, myid FROM (
  SELECT *, row_number() OVER (PARTITION BY myid ORDER BY timestamp_, doc_id) AS r FROM times
) WHERE r = 1""", "times"))
def earliest_document_per_key(spark, sf):
    store = _store(spark)
    store.write(t.times(spark, sf), "shop", "times")
    return (store.read_earliest("shop", "times", ["myid"], ["timestamp_", "doc_id"])
            .select("doc", F.col("timestamp_").alias("event_time"), "myid"))


@query("a6_append_collection", t.with_views(
    f"{BRAND_COUNTS} UNION ALL {BRAND_COUNTS}", "behavior"))
def append_collection(spark, sf):
    store = _store(spark)
    for _ in range(2):
        store.write(_brand_counts(spark, sf), "shop", "brandcounts2", mode="append")
    return store.read("shop", "brandcounts2")


@query("a7_overwrite_collection", t.with_views("""
SELECT myid, doc, timestamp_ AS event_time FROM times WHERE myid > 6 AND doc = 'V '""", "times"))
def overwrite_collection(spark, sf):
    store, documents = _store(spark), t.times(spark, sf)
    store.write(documents, "shop", "output")
    kept = documents.where((F.col("myid") > 6) & (F.col("doc") == "V "))
    store.write(kept.select("myid", "doc", F.col("timestamp_").alias("event_time")),
                "shop", "output", mode="overwrite")
    return store.read("shop", "output")


@query("a8_write_fails_if_exists", "SELECT 'PATH_ALREADY_EXISTS' AS outcome, count(*) AS n FROM customer")
def write_fails_if_exists(spark, sf):
    from pyspark.errors import AnalysisException

    store, customers = _store(spark), t.table(spark, sf, "customer")
    store.write(customers, "shop", "population")
    outcome = "written twice"
    try:
        store.write(customers, "shop", "population")
    except AnalysisException as error:
        outcome = error.getCondition()
    return store.read("shop", "population").agg(
        F.lit(outcome).alias("outcome"), F.count(F.lit(1)).alias("n"))


def _snapshots(spark):
    return Snapshots(spark, work_folder(spark, "snapshots"))


@query("a6_snapshot_append", t.with_views(f"{BRAND_COUNTS} UNION ALL {BRAND_COUNTS}", "behavior"))
def snapshot_append(spark, sf):
    """Two loads, one of them repeated after its token was committed."""
    store = _snapshots(spark)
    for token in ("monday", "tuesday", "monday"):
        store.append(_brand_counts(spark, sf), "shop", "brandcounts", token)
    return store.read("shop", "brandcounts")


@query("a7_snapshot_overwrite", t.with_views("""
SELECT 1 AS version, count(*) AS n FROM times
UNION ALL SELECT 2, count(*) FROM times WHERE myid > 6""", "times"))
def snapshot_overwrite(spark, sf):
    """A collection is replaced by a part of itself; the version before it can still be read."""
    store = _snapshots(spark)
    store.create(t.times(spark, sf), "shop", "output")
    store.overwrite(store.read("shop", "output").where(F.col("myid") > 6), "shop", "output")
    counts = [store.read("shop", "output", v).agg(F.lit(v).alias("version"), F.count(F.lit(1)).alias("n")) for v in (1, 2)]
    return counts[0].unionAll(counts[1])


@query("a8_a11_snapshot_load_once", t.with_views("""
SELECT true AS first_load, false AS second_load, 'already there' AS created, count(*) AS n FROM times""", "times"))
def snapshot_load_once(spark, sf):
    store, documents = _snapshots(spark), t.times(spark, sf)
    loads = [store.load_once(documents, "shop", "times") for _ in range(2)]
    created = "created"
    try:
        store.create(documents, "shop", "times")
    except AlreadyThere:
        created = "already there"
    return store.read("shop", "times").agg(F.lit(loads[0]).alias("first_load"), F.lit(loads[1]).alias("second_load"),
                                           F.lit(created).alias("created"), F.count(F.lit(1)).alias("n"))


@query("a9_round_trip_count", t.with_views("""
SELECT count(*) AS written, count(*) AS read_back, 0 AS missing FROM behavior""", "behavior"))
def round_trip_count(spark, sf):
    events, path = t.behavior(spark, sf), work_folder(spark, "events")
    write_events(events, path)
    back = spark.read.parquet(path).drop("event_date")
    missing = events.join(back, "event_id", "left_anti").agg(F.count(F.lit(1))).scalar()
    written = events.agg(F.count(F.lit(1))).scalar()
    return back.agg(F.count(F.lit(1)).alias("read_back")).select(
        written.alias("written"), "read_back", missing.cast("int").alias("missing"))


@query("a10_extended_json", t.with_views("""
SELECT doc, date_trunc('millisecond', timestamp_) AS event_time, myid FROM times""", "times"))
def extended_json(spark, sf):
    path = work_folder(spark, "documents")
    stamp = F.date_format("timestamp_", "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")
    (t.times(spark, sf).select(
        F.struct(F.hex("doc_id").alias("$oid")).alias("_id"), "doc",
        F.struct(stamp.alias("$date")).alias("timestamp"), "myid").write.json(path))
    return read_extended_json(spark, path).select(
        "doc", F.col("timestamp").cast("timestamp_ntz").alias("event_time"), "myid")


@query("a11_load_once", t.with_views("""
SELECT true AS first_load, false AS second_load, count(*) AS n FROM times""", "times"))
def load_once(spark, sf):
    store, documents = _store(spark), t.times(spark, sf)
    loads = [store.load_once(documents, "shop", "times") for _ in range(2)]
    return store.read("shop", "times").agg(
        F.lit(loads[0]).alias("first_load"), F.lit(loads[1]).alias("second_load"),
        F.count(F.lit(1)).alias("n"))


@query("a12_csv_round_trip", t.with_views("""
SELECT event_type, brand, count(*) AS n, round(sum(price), 2) AS price_sum FROM behavior
WHERE event_type <> 'view' GROUP BY event_type, brand""", "behavior"))
def csv_round_trip(spark, sf):
    path = work_folder(spark, "training")
    write_csv(t.behavior(spark, sf).where(F.col("event_type") != "view").select(EVENT_COLUMNS), path)
    return read_csv(spark, path).groupBy("event_type", "brand").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum("price"), 2).alias("price_sum"))


@query("a13_temp_view_sql", t.with_views("""
SELECT user_session, product_id, max(CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END) AS is_purchased_max
FROM behavior WHERE event_type IN ('cart', 'purchase') GROUP BY user_session, product_id""", "behavior"))
def temp_view_sql(spark, sf):
    t.behavior(spark, sf).createOrReplaceTempView("shop_events")
    return spark.sql("""
        SELECT user_session, product_id, max(if(event_type = 'purchase', 1, 0)) AS is_purchased_max
        FROM shop_events WHERE event_type IN ('cart', 'purchase')
        GROUP BY user_session, product_id""")


@query("a14_table_summary", t.with_views("""
, n AS (SELECT count(*) AS row_count FROM behavior),
c(position, column_name, data_type) AS (VALUES
  (0, 'event_id', 'bigint'), (1, 'event_time', 'timestamp_ntz'), (2, 'event_type', 'string'),
  (3, 'product_id', 'bigint'), (4, 'category_id', 'bigint'), (5, 'category_code', 'string'),
  (6, 'brand', 'string'), (7, 'price', 'double'), (8, 'user_id', 'bigint'),
  (9, 'user_session', 'string'))
SELECT position, column_name, data_type, row_count FROM c, n""", "behavior"))
def summary(spark, sf):
    return table_summary(t.behavior(spark, sf))
