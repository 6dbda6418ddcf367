"""Parts of an event time."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def weekday_sunday_first(column: str | Column) -> Column:
    """1 = Sunday ... 7 = Saturday."""
    return F.dayofweek(column)


def weekday_monday_first_text(column: str | Column) -> Column:
    """'0' = Monday ... '6' = Sunday, as text."""
    return F.weekday(column).cast("string")


def day_from_text(column: Column) -> Column:
    """Day held in the first ten characters of a time text."""
    return F.to_date(F.substring(column.cast("string"), 1, 10), "yyyy-MM-dd")
