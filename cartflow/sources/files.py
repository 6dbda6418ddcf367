"""CSV and JSON files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StringType, StructField, StructType, TimestampNTZType, TimestampType

from cartflow.schemas import EVENTS, TIMES_DOCUMENT


def read_csv(spark: SparkSession, paths: str | list[str], schema: StructType | str = EVENTS,
             drop_malformed: bool = False, **options: str) -> DataFrame:
    """Scan one or several CSV files with a header and a declared schema.

    ``drop_malformed`` leaves out rows with a wrong number of fields or a field that does
    not fit its type. The reader itself checks only the columns a query asks for, so the
    fields are read as text and the check is a filter of its own: the same rows are
    dropped whatever is selected afterwards.
    """
    reader = spark.read.option("header", True).options(**options)
    if not drop_malformed:
        return reader.schema(schema).csv(paths)
    fields = (StructType.fromDDL(schema) if isinstance(schema, str) else schema).fields
    text = (reader.schema(StructType([StructField(f.name, StringType()) for f in fields]))
            .option("mode", "DROPMALFORMED").option("columnPruning", False).csv(paths))
    fits = F.lit(True)
    for f in fields:
        fits &= F.col(f.name).isNull() | _parsed(f, options).isNotNull()
    return text.where(fits).select(*[_parsed(f, options).alias(f.name) for f in fields])


# Reader option that gives the format of each type.
FORMATS = {DateType: "dateFormat", TimestampType: "timestampFormat", TimestampNTZType: "timestampNTZFormat"}


def _parsed(field: StructField, options: dict[str, str]) -> Column:
    """The text of a field as its type, by the reader's format where one is given; null if it does not fit."""
    pattern = options.get(FORMATS.get(type(field.dataType), ""))
    value = F.col(field.name)
    if pattern is None:
        return value.try_cast(field.dataType)
    return F.try_to_timestamp(value, F.lit(pattern)).cast(field.dataType)


def write_csv(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Write with a header, no row index, and times to the microsecond."""
    stamp = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
    (df.write.mode(mode).option("header", True)
       .option("timestampNTZFormat", stamp).option("timestampFormat", stamp + "XXX").csv(path))


def read_extended_json(spark: SparkSession, path: str) -> DataFrame:
    """Lines of exported documents (``$oid``, ``$date``) as flat ``(doc, timestamp, myid)`` rows."""
    raw = spark.read.schema(TIMES_DOCUMENT).json(path)
    return raw.select("doc", F.to_timestamp(F.col("timestamp.`$date`")).alias("timestamp"), "myid")


def write_events(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Store events as parquet partitioned by day, so date filters prune whole folders.

    Rebalancing brings a day's rows together without tying a day to one task: adaptive
    execution splits a large day and joins small ones by size.
    """
    (df.withColumn("event_date", F.to_date("event_time")).hint("rebalance", "event_date")
       .write.mode(mode).partitionBy("event_date").parquet(path))
