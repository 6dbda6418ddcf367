"""Funnels in sequence: how far each group got through steps that must follow one another in order.

A row moves its group from stage s to s + 1 when it is the step that stage s waits for. That is an automaton, and
what a run of rows does to it is a function from the stage before the run to the stage after. Rows are range-sliced by
group and order (``plans/ordered``), every slice works out its function for all starting stages, and the functions of
a group's slices are applied one after another. So a group with a third of all rows takes as many tasks as it has slices,
and only one function (an array of stages) a slice travels on.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cartflow.plans.ordered import SLICE, _columns, _join_carry, slice_by_order


def _walked(df: DataFrame, order: list[str | Column], group: list[str], steps: list[Column], slices: int | None) -> DataFrame:
    """Sliced rows with ``_to_s``, the stage after the row for a slice that starts at stage s."""
    order = _columns(order)
    marked = df.select("*", *[F.coalesce(step, F.lit(False)).alias(f"_step_{s}") for s, step in enumerate(steps)])
    rows = slice_by_order(marked, order, group, slices)
    upto = Window.partitionBy(SLICE, *group).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    before = Window.partitionBy(SLICE, *group).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    # _passed_s_t: a slice that starts at stage s has passed step t by this row, which needs step t - 1 on an earlier row.
    for length in range(len(steps)):
        rows = rows.select("*", *[
            F.max(F.col(f"_step_{s + length}") if not length else F.col(f"_step_{s + length}") & F.col(f"_ready_{s}")).over(upto)
            .alias(f"_passed_{s}_{s + length}") for s in range(len(steps) - length)])
        rows = rows.drop(*[f"_ready_{s}" for s in range(len(steps))])
        rows = rows.select("*", *[F.coalesce(F.max(f"_passed_{s}_{s + length}").over(before), F.lit(False)).alias(f"_ready_{s}")
                                  for s in range(len(steps) - length - 1)])
    return rows.select(*df.columns, SLICE, *[
        sum((F.col(f"_passed_{s}_{t}").cast("int") for t in range(s, len(steps))), F.lit(s)).alias(f"_to_{s}")
        for s in range(len(steps) + 1)])


def _functions(walked: DataFrame, group: list[str], n: int) -> DataFrame:
    """A group's slices in order, each with its function as the array of stages it leads to. Stages never fall."""
    per_slice = walked.groupBy(SLICE, *group).agg(F.array(*[F.max(f"_to_{s}") for s in range(n + 1)]).alias("_to"))
    return per_slice.groupBy(*group).agg(F.sort_array(F.collect_list(F.struct(SLICE, "_to"))).alias("_slices"))


def funnel_stages(df: DataFrame, order: list[str | Column], group: list[str], steps: list[Column],
                  name: str = "stage", slices: int | None = None) -> DataFrame:
    """Every row with the stage of its group after it: 0 before the first step, ``len(steps)`` after the last.

    ``order`` ends in a unique column. One row passes one step at most; a null condition does not hold; null groups
    are a group of their own.
    """
    group = list(group)
    walked = _walked(df, order, group, steps, slices)
    empty = F.struct(F.lit(0).alias("at"), F.array().cast(f"array<struct<{SLICE}:int,_from:int>>").alias("seen"))
    scanned = F.aggregate("_slices", empty, lambda acc, one: F.struct(
        F.get(one["_to"], acc["at"]).alias("at"),
        F.concat(acc["seen"], F.array(F.struct(one[SLICE].alias(SLICE), acc["at"].alias("_from")))).alias("seen")), lambda acc: acc["seen"])
    # Only slices that a group enters from an earlier one: a row a slice at most, as such a group is the first of its slice.
    carry = (_functions(walked, group, len(steps)).where(F.size("_slices") > 1)
             .select(*group, F.inline(F.slice(scanned, 2, F.size("_slices") - 1))).where(F.col("_from") > 0))
    joined = _join_carry(walked, carry, group)
    stage = F.get(F.array(*[F.col(f"_to_{s}") for s in range(len(steps) + 1)]), F.coalesce("_from", F.lit(0)))
    return joined.select(*df.columns, stage.alias(name))


def furthest_stage(df: DataFrame, order: list[str], group: list[str], steps: list[Column],
                   name: str = "stage", slices: int | None = None) -> DataFrame:
    """One row for each group: the stage it ends at. Only the columns named here are sliced."""
    group = list(group)
    narrow = df.select(*dict.fromkeys([*group, *order]), *[c.alias(f"_c_{i}") for i, c in enumerate(steps)])
    walked = _walked(narrow, order, group, [F.col(f"_c_{i}") for i in range(len(steps))], slices)
    return _functions(walked, group, len(steps)).select(
        *group, F.aggregate("_slices", F.lit(0), lambda at, one: F.get(one["_to"], at)).alias(name))


def funnel_counts(stages: DataFrame, n_steps: int, name: str = "stage") -> DataFrame:
    """``(stage, n_groups, percent)``: groups that reached at least each stage, and their share of all groups."""
    reached = stages.select(F.explode(F.sequence(F.lit(0), F.col(name))).alias(name)).groupBy(name).agg(F.count(F.lit(1)).alias("n"))
    every = stages.sparkSession.range(n_steps + 1).select(F.col("id").cast("int").alias(name))
    n = F.coalesce("n", F.lit(0))
    total = stages.agg(F.count(F.lit(1)).alias("n")).scalar()
    return every.join(F.broadcast(reached), name, "left").select(
        name, n.alias("n_groups"), F.try_divide(n * 100.0, total).alias("percent"))
