"""Running totals, positions and neighbours along an order, without a one-task window.

``row_number() OVER (ORDER BY x)`` and its relatives pull every row (or every row of a
hot group) into one task. Here the rows are range-partitioned by group *and* order, so a
hot group is spread over as many slices as it needs. A window inside each slice and
a carry from the slices before it then give the same numbers.

The sliced rows are checkpointed, because range bounds come from a sample: a slice
computed again (a second scan, a lost executor) could otherwise be cut elsewhere.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cartflow.session import materialise

SLICE = "_slice"


def _columns(names: list[str | Column]) -> list[Column]:
    return [F.col(n) if isinstance(n, str) else n for n in names]


def slice_by_order(df: DataFrame, order: list[str | Column], group: list[str] = (),
                   slices: int | None = None) -> DataFrame:
    """Range-partition ``df`` by group and order and number the partitions in ``_slice``.

    ``order`` should end in a unique column: equal keys always share a slice.
    """
    keys = [*_columns(list(group)), *_columns(order)]
    ranged = df.repartitionByRange(slices, *keys) if slices else df.repartitionByRange(*keys)
    return materialise(ranged.withColumn(SLICE, F.spark_partition_id()))


def _carry(sliced: DataFrame, group: list[str], aggregates: list[Column],
           combine: dict[str, Column]) -> DataFrame:
    """What each (slice, group) inherits from earlier slices of the same group.

    A group that reaches back into an earlier slice must be the first group of its slice,
    so this has at most one row per slice, which is what makes it safe to broadcast.
    """
    per_slice = sliced.groupBy(SLICE, *group).agg(*aggregates)
    back = Window.partitionBy(*group).orderBy(SLICE)
    return (
        per_slice
        .select(SLICE, *group, F.lag(SLICE).over(back).alias("_earlier"),
                *[value.over(back.rowsBetween(Window.unboundedPreceding, -1)).alias(name)
                  for name, value in combine.items()])
        .where(F.col("_earlier").isNotNull())
        .drop("_earlier")
    )


def _join_carry(rows: DataFrame, carry: DataFrame, group: list[str]) -> DataFrame:
    carry = carry.select(F.col(SLICE).alias("_c_slice"),
                         *[F.col(g).alias(f"_c_{g}") for g in group],
                         *[c for c in carry.columns if c not in (SLICE, *group)])
    match = F.col(SLICE) == F.col("_c_slice")
    for g in group:
        match &= F.col(g).eqNullSafe(F.col(f"_c_{g}"))
    return rows.join(F.broadcast(carry), match, "left").drop("_c_slice", *[f"_c_{g}" for g in group])


def running_totals(df: DataFrame, order: list[str | Column], totals: dict[str, Column],
                   group: list[str] = (), slices: int | None = None) -> DataFrame:
    """Add, for each entry of ``totals``, its sum over this row and all rows before it."""
    group = list(group)
    order = _columns(order)
    staged = df.select("*", *[value.alias(f"_v_{name}") for name, value in totals.items()])
    sliced = slice_by_order(staged, order, group, slices)
    carry = _carry(
        sliced, group,
        [F.sum(f"_v_{n}").alias(f"_v_{n}") for n in totals],
        {f"_c_{n}": F.sum(f"_v_{n}") for n in totals},
    )
    inside = (Window.partitionBy(SLICE, *group).orderBy(*order)
              .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    within = sliced.select("*", *[F.sum(f"_v_{n}").over(inside).alias(f"_w_{n}") for n in totals])
    joined = _join_carry(within, carry, group)
    return joined.select(
        *df.columns,
        *[(F.col(f"_w_{n}") + F.coalesce(F.col(f"_c_{n}"), F.lit(0))).alias(n) for n in totals])


def positions(df: DataFrame, order: list[str | Column], name: str = "position",
              group: list[str] = (), slices: int | None = None) -> DataFrame:
    """Number the rows 1, 2, 3 ... along the order (inside each group, if one is given)."""
    return running_totals(df, order, {name: F.lit(1).cast("bigint")}, group, slices)


def steps_with_previous(df: DataFrame, order: list[str | Column], group: list[str],
                        value: str, step: str = "step", previous: str = "previous",
                        slices: int | None = None) -> DataFrame:
    """Position inside the group, and the ``value`` of the row just before (null at the first)."""
    group = list(group)
    order = _columns(order)
    keys = F.struct(*[c.alias(f"o{i}") for i, c in enumerate(order)])
    sliced = slice_by_order(df, order, group, slices)
    carry = _carry(
        sliced, group,
        [F.count(F.lit(1)).alias("_n"),
         F.max_by(F.struct(F.col(value).alias("v")), keys).alias("_last")],
        {"_rows_before": F.sum("_n"), "_last_before": F.last("_last")},
    )
    inside = Window.partitionBy(SLICE, *group).orderBy(*order)
    within = sliced.select("*", F.row_number().over(inside).cast("bigint").alias("_rn"),
                           F.lag(value).over(inside).alias("_lag"))
    joined = _join_carry(within, carry, group)
    return joined.select(
        *df.columns,
        (F.col("_rn") + F.coalesce(F.col("_rows_before"), F.lit(0))).alias(step),
        F.when(F.col("_rn") == 1, F.col("_last_before.v")).otherwise(F.col("_lag")).alias(previous))
