"""Fixed schemas, so no reader has to infer one."""

from pyspark.sql import types as T


def _schema(*fields: tuple) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in fields])


EVENTS = _schema(
    ("event_time", T.TimestampNTZType()),
    ("event_type", T.StringType()),
    ("product_id", T.LongType()),
    ("category_id", T.LongType()),
    ("category_code", T.StringType()),
    ("brand", T.StringType()),
    ("price", T.DoubleType()),
    ("user_id", T.LongType()),
    ("user_session", T.StringType()),
)

# The same table with a row id, which gives "keep the first row" a defined tie-break.
EVENTS_WITH_ID = T.StructType([T.StructField("event_id", T.LongType(), True), *EVENTS.fields])

TRANSACTIONS = _schema(
    ("transaction_id", T.LongType()),
    ("is_fraud", T.IntegerType()),
    ("transaction_dt", T.LongType()),
    ("transaction_amt", T.DoubleType()),
    ("p_emaildomain", T.StringType()),
    ("r_emaildomain", T.StringType()),
    ("constant_col", T.StringType()),
    ("dominant_col", T.StringType()),
)

IDENTITY = _schema(
    ("transaction_id", T.LongType()),
    ("device_info", T.StringType()),
    ("id_30", T.StringType()),
    ("id_31", T.StringType()),
    ("id_33", T.StringType()),
    ("id_34", T.StringType()),
    ("id_23", T.StringType()),
)

# Extended-JSON documents as they are exported from a document store.
TIMES_DOCUMENT = T.StructType([
    T.StructField("_id", T.StructType([T.StructField("$oid", T.StringType())])),
    T.StructField("doc", T.StringType()),
    T.StructField("timestamp", T.StructType([T.StructField("$date", T.StringType())])),
    T.StructField("myid", T.DoubleType()),
])

METRIC_SAMPLES = _schema(
    ("ts", T.TimestampNTZType()),
    ("metric", T.StringType()),
    ("topic", T.StringType()),
    ("instance", T.LongType()),
    ("value", T.DoubleType()),
)

LEADERBOARD = _schema(
    ("accuracy", T.DoubleType()),
    ("area_roc", T.DoubleType()),
    ("model", T.StringType()),
)
