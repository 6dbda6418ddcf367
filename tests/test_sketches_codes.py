"""Stored daily sketches, and out-of-fold rates against plain counts."""

import datetime
from collections import Counter

from pyspark.sql import functions as F

from cartflow.operators import evaluation, sketches, target_codes
from cartflow.operators.sampling import random_folds
from cartflow.session import work_folder

DAY = datetime.date(2024, 3, 1)


def _events(spark, first, days, users):
    return spark.range(days * users).select(
        F.expr(f"timestamp'2024-03-01' + make_dt_interval({first} + cast(id % {days} as int))").alias("event_time"),
        (F.floor(F.col("id") / days) + (F.col("id") % days) * (users // 2)).alias("user_id"))


def test_ranges_come_near_the_exact_number(spark):
    path = work_folder(spark, "days")
    sketches.save_days(sketches.daily_sketches(_events(spark, 0, 5, 20_000)), path)
    # The second load brings day 4 again and day 5: it replaces one day and adds one.
    sketches.save_days(sketches.daily_sketches(_events(spark, 4, 2, 20_000)), path)
    days = sketches.stored_days(spark, path)
    assert days.count() == 6
    ranges = [(0, 0), (0, 3), (4, 5), (2, 2), (9, 12), (3, 1)]
    asked = spark.createDataFrame([(DAY + datetime.timedelta(a), DAY + datetime.timedelta(b)) for a, b in ranges + ranges[:1]] + [(DAY, None)],
                                  "first_day date, last_day date")
    got = {((r.first_day - DAY).days, (r.last_day - DAY).days if r.last_day else None): r.visitors
           for r in sketches.distinct_over(days, asked).collect()}
    exact = {(0, 0): 20_000, (0, 3): 50_000, (4, 5): 30_000, (2, 2): 20_000, (9, 12): 0, (3, 1): 0, (0, None): 0}
    assert set(got) == set(exact)
    assert all(abs(got[k] - n) <= sketches.ERROR * n for k, n in exact.items())


def test_sketch_of_no_rows(spark):
    empty = sketches.daily_sketches(_events(spark, 0, 1, 10).limit(0))
    assert empty.count() == 0


def _labelled(spark):
    """A value with a third of all rows, rare ones, nulls, and a random column of many values."""
    rows = spark.range(30_000).select(
        "id", F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 7 == 0, None).otherwise(
            F.concat(F.lit("v"), (F.col("id") % 500).cast("string"))).alias("c"),
        (F.pmod(F.xxhash64("id"), F.lit(15_000))).alias("noise"),
        (F.pmod(F.xxhash64("id", F.lit(1)), F.lit(4)) == 0).cast("int").alias("y"))
    return random_folds(rows, 5, "id", 3).persist()


def test_rates_equal_plain_counts(spark):
    rows = _labelled(spark)
    codes = target_codes.learn(rows, ["c"], "y", "fold", strength=5.0)
    plain = rows.collect()
    n, s, nf, sf = Counter(), Counter(), Counter(), Counter()
    for r in plain:
        for key in (("all",), ("of", r.c)):
            n[key] += 1
            s[key] += r.y
            nf[key, r.fold] += 1
            sf[key, r.fold] += r.y
    for r in codes.out_of_fold(rows, "fold").collect():
        own, every = ("of", r.c), ("all",)
        prior = (s[every] - sf[every, r.fold]) / (n[every] - nf[every, r.fold])
        assert abs(r.c_rate - (s[own] - sf[own, r.fold] + 5 * prior) / (n[own] - nf[own, r.fold] + 5)) < 1e-12
    other = spark.createDataFrame([("hot",), (None,), ("never seen",)], "c string")
    average = s["all",] / n["all",]
    for r in codes.transform(other).collect():
        own = ("of", r.c)
        assert abs(r.c_rate - (s[own] + 5 * average) / (n[own] + 5)) < 1e-12


def test_a_random_column_tells_nothing(spark):
    """Whole rates of a column of many values seem to tell the label of their own rows; out-of-fold rates do not."""
    rows = _labelled(spark)
    codes = target_codes.learn(rows, ["noise"], "y", "fold", strength=1.0)
    area = lambda df: evaluation.area_under_roc(df.select(F.col("y").alias("label"), F.col("noise_rate").alias("score"))).first()[0]
    assert area(codes.transform(rows)) > 0.75
    assert abs(area(codes.out_of_fold(rows, "fold")) - 0.5) < 0.02


def test_no_rows_and_no_labels(spark):
    none = _labelled(spark).limit(0)
    codes = target_codes.learn(none, ["c"], "y", "fold")
    assert codes.out_of_fold(none, "fold").count() == 0
    assert [r.c_rate for r in codes.transform(spark.createDataFrame([("x",)], "c string")).collect()] == [0.0]
