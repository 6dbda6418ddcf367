"""Funnels against a plain walk over the rows, with one group over many slices."""

from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from cartflow.operators.funnel import funnel_counts, funnel_stages, furthest_stage


@pytest.fixture(scope="module")
def rows(spark):
    group = F.when(F.col("id") % 10 < 7, "hot").when(F.col("id") % 10 == 9, None).otherwise(
        F.concat(F.lit("g"), (F.col("id") % 23).cast("string")))
    kind = F.element_at(F.array(*map(F.lit, "aabbbdc")), ((F.col("id") * 31) % 7 + 1).cast("int"))
    # The hot group sees its steps in different slices: all its a are late, c last.
    return spark.range(2000).select("id", group.alias("g"), ((F.col("id") * 7919) % 101).alias("t"),
                                    F.when(F.col("id") % 11 == 3, None).otherwise(kind).alias("kind")).persist()


def _walk(rows, steps, least):
    by_group, after = defaultdict(list), {}
    for r in rows.collect():
        by_group[r.g].append(r)
    for events in by_group.values():
        stage = 0
        for r in sorted(events, key=lambda r: (r.t, r.id)):
            if stage < len(steps) and r.kind == steps[stage] and r.t >= least[stage]:
                stage += 1
            after[r.id] = (r.g, stage)
    return after


@pytest.mark.parametrize("slices", [1, 7, 60])
@pytest.mark.parametrize("steps, least", [("abc", (0, 0, 0)), ("abc", (20, 55, 90)), ("aa", (0, 100)), ("c", (50,)), ("abca", (5, 30, 60, 99))])
def test_stages_are_those_of_a_walk(rows, steps, least, slices):
    conditions = [(F.col("kind") == s) & (F.col("t") >= n) for s, n in zip(steps, least)]
    expected = _walk(rows, steps, least)
    got = funnel_stages(rows, ["t", "id"], ["g"], conditions, slices=slices).collect()
    assert {r.id: (r.g, r.stage) for r in got} == expected and len(got) == 2000
    last = {}
    for r in sorted(rows.collect(), key=lambda r: (r.t, r.id)):
        last[r.g] = expected[r.id][1]
    assert {r.g: r.stage for r in furthest_stage(rows, ["t", "id"], ["g"], conditions, slices=slices).collect()} == last


def test_counts_hold_every_stage(spark):
    stages = spark.createDataFrame([("a", 0), ("b", 2), ("c", 2), (None, 1)], "g string, stage int")
    assert [tuple(r) for r in funnel_counts(stages, 3).orderBy("stage").collect()] == [
        (0, 4, 100.0), (1, 3, 75.0), (2, 2, 50.0), (3, 0, 0.0)]


def test_no_rows(rows):
    assert furthest_stage(rows.limit(0), ["t", "id"], ["g"], [F.col("kind") == "a"]).count() == 0
    assert funnel_counts(furthest_stage(rows.limit(0), ["t", "id"], ["g"], [F.col("kind") == "a"]), 1).where("n_groups > 0").count() == 0
