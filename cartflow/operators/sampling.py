"""Balancing, splitting and folding.

Every random choice is a hash of a row key and a seed, so it does not depend on how the
rows are partitioned and a recomputed task chooses the same rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cartflow.functions.numeric import HASH_PRIME, hash_number
from cartflow.plans.lookup import lookup_join
from cartflow.plans.ordered import positions


# Hashes are counted in this many low-order steps, which makes 65,536 buckets.
BUCKET_BITS = 15


def hash_edge(share: float) -> int:
    """The hash below which about ``share`` of all keys lie."""
    return round(share * HASH_PRIME)


def sample_per_class(df: DataFrame, label: str, n: int, key: str, seed: int = 27) -> DataFrame:
    """Exactly ``n`` rows of every class, without replacement; ``key`` is a unique whole number.

    Takes the ``n`` smallest hashes. Counting hashes in 65,536 buckets finds the bucket
    where the ``n``-th lies: rows in lower buckets are taken by a filter, and only that
    one bucket of each class is ranked. Ranking whole classes would use one task each.
    """
    hashed = df.withColumn("_h", hash_number(key, seed)).withColumn(
        "_bucket", F.shiftright("_h", BUCKET_BITS))
    sizes = hashed.groupBy(label, "_bucket").agg(F.count(F.lit(1)).alias("_n"))
    upto = Window.partitionBy(label).orderBy("_bucket").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    running = sizes.withColumn("_upto", F.sum("_n").over(upto))
    cut = running.groupBy(label).agg(
        F.min(F.when(F.col("_upto") >= n, F.col("_bucket"))).alias("_cut"),
        F.coalesce(F.max(F.when(F.col("_upto") < n, F.col("_upto"))), F.lit(0)).alias("_below"),
        F.max("_upto").alias("_size"))
    short = cut.where(F.col("_size") < n).limit(1).collect()
    if short:
        raise ValueError(f"class {short[0][label]!r} has {short[0]['_size']} rows, {n} asked for")
    marked = lookup_join(hashed, cut.drop("_size"), [label], "inner")
    below = marked.where(F.col("_bucket") < F.col("_cut"))
    edge_rank = F.row_number().over(Window.partitionBy(label).orderBy("_h", key))
    edge = (marked.where(F.col("_bucket") == F.col("_cut")).withColumn("_rank", edge_rank)
            .where(F.col("_rank") <= n - F.col("_below")).drop("_rank"))
    return below.unionByName(edge).select(*df.columns)


def repeat_rows(df: DataFrame, times: int) -> DataFrame:
    """Every row ``times`` times."""
    return df.select("*", F.explode(F.sequence(F.lit(1), F.lit(times))).alias("_copy")).drop("_copy")


def oversample_minority(df: DataFrame, label: str) -> DataFrame:
    """Repeat the rows of the smaller class (0 or 1) by the whole-number ratio of the sizes."""
    sizes = df.agg(F.count_if(F.col(label) == 0).alias("n0"), F.count_if(F.col(label) == 1).alias("n1")).first()
    minor = 1 if sizes["n1"] <= sizes["n0"] else 0
    few, many = sorted((sizes["n0"], sizes["n1"]))
    if not few:
        return df.where(F.col(label) == 1 - minor)
    return df.where(F.col(label) == 1 - minor).unionByName(
        repeat_rows(df.where(F.col(label) == minor), many // few))


def with_part(df: DataFrame, weights: dict[str, float], key: str, seed: int,
              name: str = "part") -> DataFrame:
    """Name the split part of each row; weights are normalised and no shuffle is needed."""
    total, bits, reached = sum(weights.values()), hash_number(key, seed), 0.0
    *parts, last = weights
    choice = F.lit(last)
    edges = []
    for part in parts:
        reached += weights[part] / total
        edges.append((part, hash_edge(reached)))
    for part, edge in reversed(edges):
        choice = F.when(bits < edge, part).otherwise(choice)
    return df.withColumn(name, choice)


def random_split(df: DataFrame, weights: list[float], key: str, seed: int) -> list[DataFrame]:
    """Disjoint, complete parts with about the given weights."""
    named = with_part(df, {str(i): w for i, w in enumerate(weights)}, key, seed, "_part")
    return [named.where(F.col("_part") == str(i)).drop("_part") for i in range(len(weights))]


def random_folds(df: DataFrame, k: int, key: str, seed: int, name: str = "fold") -> DataFrame:
    """Fold number 0 .. k-1 by hash."""
    named = with_part(df, {str(i): 1 / k for i in range(k)}, key, seed, name)
    return named.withColumn(name, F.col(name).cast("int"))


def contiguous_folds(df: DataFrame, k: int, order: list[str | Column], name: str = "fold",
                     slices: int | None = None) -> DataFrame:
    """Fold number 1 .. k by position in the order; sizes differ by at most one, larger first."""
    rows = df.count()
    small, larger = divmod(rows, k)
    numbered = positions(df, order, "_position", slices=slices)
    index, head = F.col("_position") - 1, larger * (small + 1)
    fold = F.when(index < head, F.floor(index / (small + 1))).otherwise(
        larger + F.floor((index - head) / max(small, 1)))
    return numbered.withColumn(name, (fold + 1).cast("int")).drop("_position")


def ordered_limit(df: DataFrame, n: int, order: list[str | Column]) -> DataFrame:
    """The first ``n`` rows of a defined order (a top-k, not an arbitrary slice)."""
    return df.orderBy(*order).limit(n)
