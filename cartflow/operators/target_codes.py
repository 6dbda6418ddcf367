"""Categories of any number of values as one number each: the smoothed share of positive labels.

A tree that takes a column by index needs a bin for every value; a rate is an ordinary number and takes as many bins as any.
For rows that the rates are learned from, the rate leaves out the row's own fold, as a value seen once would else tell
its row's label.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartflow.plans.lookup import lookup_join
from cartflow.session import materialise

# Rows of the average rate that every value is mixed with.
STRENGTH = 20.0


def _key(column: str) -> Column:
    """The value as text; null is a value of its own."""
    return F.coalesce(F.concat(F.lit("="), F.col(column).cast("string")), F.lit("null"))


@dataclass
class TargetCodes:
    """``(column_name, key, n, positive, folds)``, where ``folds`` maps a fold to its own (n, positive); and these sums for all rows."""

    table: DataFrame
    all_rows: dict[int, tuple[int, int]]
    columns: list[str]
    strength: float

    def _rates(self, df: DataFrame, fold: str | None, suffix: str) -> DataFrame:
        """Counts are exact, so a rate does not depend on the order of rows."""
        total_n, total_positive = (sum(c) for c in zip(*self.all_rows.values())) if self.all_rows else (0, 0)
        average = F.lit(total_positive / total_n if total_n else 0.0)
        if fold:
            for f, (n, positive) in sorted(self.all_rows.items()):
                rest = total_n - n
                average = F.when(F.col(fold) == f, F.lit((total_positive - positive) / rest if rest else 0.0)).otherwise(average)
        out = df
        for c in self.columns:
            one = self.table.where(F.col("column_name") == c).select(
                F.col("key").alias("_key"), F.col("n").alias("_n"), F.col("positive").alias("_positive"), F.col("folds").alias("_folds"))
            joined = lookup_join(out.withColumn("_key", _key(c)), one, ["_key"], "left")
            n, positive = F.coalesce("_n", F.lit(0)), F.coalesce("_positive", F.lit(0))
            if fold:
                own = F.try_element_at("_folds", F.col(fold))
                n, positive = n - F.coalesce(own["n"], F.lit(0)), positive - F.coalesce(own["positive"], F.lit(0))
            rate = (positive + self.strength * average) / (n + F.lit(self.strength))
            out = joined.withColumn(f"{c}{suffix}", rate).drop("_key", "_n", "_positive", "_folds")
        return out.select(*df.columns, *[f"{c}{suffix}" for c in self.columns])

    def out_of_fold(self, df: DataFrame, fold: str, suffix: str = "_rate") -> DataFrame:
        """Rates for the rows that were learned from, each without its own fold."""
        return self._rates(df, fold, suffix)

    def transform(self, df: DataFrame, suffix: str = "_rate") -> DataFrame:
        """Rates for other rows, from all rows learned from; unseen values get the average."""
        return self._rates(df, None, suffix)


def learn(df: DataFrame, columns: list[str], label: str, fold: str, strength: float = STRENGTH) -> TargetCodes:
    """Count labels (0 or 1) by value and fold, all columns in one scan; tasks send a row a value and fold.

    ``fold`` is a small whole number (random or contiguous folds). Rows without a label or fold are not counted.
    The table is stored, so that a value with a third of all rows is split by adaptive execution where its
    column is too wide to broadcast.
    """
    counted = df.where(F.col(label).isNotNull() & F.col(fold).isNotNull())
    cells = counted.select(F.col(fold).cast("int").alias("fold"), F.col(label).cast("long").alias("y"), F.inline(F.array(*[
        F.struct(F.lit(c).alias("column_name"), _key(c).alias("key")) for c in columns])))
    by_fold = cells.groupBy("column_name", "key", "fold").agg(F.count(F.lit(1)).alias("n"), F.sum("y").alias("positive"))
    table = by_fold.groupBy("column_name", "key").agg(
        F.sum("n").alias("n"), F.sum("positive").alias("positive"),
        F.map_from_entries(F.collect_list(F.struct("fold", F.struct("n", "positive")))).alias("folds"))
    table = materialise(table)
    sums = (table.where(F.col("column_name") == columns[0]).select(F.explode("folds").alias("fold", "own"))
            .groupBy("fold").agg(F.sum("own.n").alias("n"), F.sum("own.positive").alias("positive")).collect())
    return TargetCodes(table, {r["fold"]: (r["n"], r["positive"]) for r in sums}, list(columns), strength)
