"""Rates, sums, alerts and quantiles over metric samples ``(ts, metric, topic, instance, value)``.

Times without a zone are read in the session time zone, which is UTC here.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cartflow.plans.ordered import running_totals

SERIES = ["metric", "topic", "instance"]
MICROS = 1_000_000


def _micros(column: str):
    return F.unix_micros(F.col(column).cast("timestamp"))


def counter_rate(df: DataFrame, window_seconds: int = 300, series: list[str] = SERIES,
                 chunk_seconds: int = 3600) -> DataFrame:
    """Per-second increase of a counter over the trailing window, at every sample.

    A value below the one before is a restart and counts in full; the first sample of a
    series counts 0; samples of equal time come in the order of their values; the window's edges are not extrapolated. A series is handled in
    chunks of time: each chunk is told the last value before it and is given the tail of
    the chunk before it, so one long series is spread over many tasks. The trailing sum
    is a running sum of increases entering and leaving, so its cost per sample does not
    depend on how many samples the window holds.
    """
    chunk, span = chunk_seconds * MICROS, window_seconds * MICROS
    if chunk < span:
        raise ValueError("a chunk must be at least as long as the window")
    samples = df.withColumn("_m", _micros("ts")).withColumn("_chunk", F.floor(F.col("_m") / chunk))
    last = samples.groupBy(*series, "_chunk").agg(F.max_by("value", F.struct("_m", "value")).alias("_last"))
    carried = last.select(*series, "_chunk", F.lag("_last").over(
        Window.partitionBy(*series).orderBy("_chunk")).alias("_carried"))
    inside = Window.partitionBy(*series, "_chunk").orderBy("_m", "value")
    before = F.coalesce(F.lag("value").over(inside), F.col("_carried"))
    grown = samples.join(carried, [*series, "_chunk"]).withColumn(
        "_increase", F.when(before.isNull(), 0.0).when(F.col("value") < before, F.col("value"))
        .otherwise(F.col("value") - before))
    # Every increase enters the sum at its time and leaves it just after one window. The
    # entry is repeated in the next chunk when the leaving falls there.
    home = F.col("_chunk")
    leaves_later = F.col("_m") + span >= (home + 1) * chunk
    reach = F.when(leaves_later, F.array(home, home + 1)).otherwise(F.array(home))
    spread = grown.select(*df.columns, "_m", "_increase", home.alias("_home"),
                          F.explode(reach).alias("_chunk")).repartition(*series, "_chunk")
    enter = F.struct(F.col("_m").alias("at"), F.lit(0).alias("side"), F.col("_increase").alias("by"))
    leave = F.struct((F.col("_m") + span).alias("at"), F.lit(1).alias("side"), (-F.col("_increase")).alias("by"))
    moves = spread.select("*", F.explode(F.array(enter, leave)).alias("_move"))
    so_far = (Window.partitionBy(*series, "_chunk").orderBy("_move.at", "_move.side")
              .rangeBetween(Window.unboundedPreceding, Window.currentRow))
    # Doubles that enter and leave may not cancel to the last bit, so an idle window is told by its count of increases.
    grows = F.when(F.col("_move.by") > 0, 1).when(F.col("_move.by") < 0, -1).otherwise(0)
    total = F.when(F.sum(grows).over(so_far) == 0, 0.0).otherwise(F.sum("_move.by").over(so_far))
    return (moves.withColumn("rate", total / window_seconds)
            .where((F.col("_move.side") == 0) & (F.col("_home") == F.col("_chunk")))
            .select(*df.columns, "rate"))


def sum_without(df: DataFrame, value: str, dropped: list[str], labels: list[str] = SERIES,
                step: str = "minute") -> DataFrame:
    """Each series' latest value per step, summed over the dropped labels.

    Samples without a topic are left out.
    """
    kept = [c for c in labels if c not in dropped]
    latest = (df.where(F.col("topic") != "")
              .groupBy(F.date_trunc(step, "ts").cast("timestamp_ntz").alias("ts"), *labels)
              .agg(F.max_by(value, F.struct("ts", value)).alias(value)))
    return latest.groupBy("ts", *kept).agg(F.sum(value).alias(value))


def topic_rates(df: DataFrame, window_seconds: int = 300) -> DataFrame:
    """Rate per metric and topic, summed over instances."""
    return sum_without(counter_rate(df, window_seconds), "rate", ["instance"])


def missing_instances(df: DataFrame, expected: int = 2, hold_minutes: int = 1) -> DataFrame:
    """Minutes in which fewer than ``expected`` instances report, and whether the alert fires.

    It fires once this has held for ``hold_minutes``. A minute with no sample at all
    has no count and ends the run. Every short minute is passed on to the minutes it can support and
    these are counted, so no window has to walk the whole time line.
    """
    minute = F.date_trunc("minute", "ts").cast("timestamp_ntz")
    short = (df.groupBy("metric", minute.alias("minute"))
             .agg(F.count_distinct("instance").alias("instances"))
             .where(F.col("instances") < expected))
    ahead = F.explode(F.sequence(F.lit(0), F.lit(hold_minutes))).alias("_ahead")
    reach = short.select("metric", "minute", "instances", ahead).select(
        "metric", (F.col("minute") + F.make_dt_interval(mins=F.col("_ahead"))).alias("minute"),
        F.when(F.col("_ahead") == 0, F.col("instances")).alias("instances"))
    return (reach.groupBy("metric", "minute")
            .agg(F.max("instances").alias("instances"), F.count(F.lit(1)).alias("_held"))
            .where(F.col("instances").isNotNull())
            .select("metric", "minute", "instances",
                    (F.col("_held") == hold_minutes + 1).alias("firing")))


def quantiles(df: DataFrame, probabilities: list[float], group: list[str],
              accuracy: int = 10_000) -> DataFrame:
    """Approximate quantiles per group: a bounded sketch, merged from every task."""
    return df.groupBy(*group).agg(
        F.percentile_approx("value", probabilities, accuracy).alias("_q")
    ).select(*group, F.inline(F.arrays_zip(
        F.array(*map(F.lit, probabilities)).alias("quantile"), F.col("_q").alias("value"))))


def exact_quantiles(df: DataFrame, probabilities: list[float], group: list[str],
                    slices: int | None = None) -> DataFrame:
    """Exact, linearly interpolated quantiles per group: ``(group, quantile, value)``.

    Values are counted first and ranked by range-sliced running totals; the built-in exact
    percentile would hold all values of a group in one task.
    """
    counts = (df.where(F.col("value").isNotNull()).groupBy(*group, "value")
              .agg(F.count(F.lit(1)).alias("n")))
    ranked = running_totals(counts, ["value"], {"upto": F.col("n")}, group, slices)
    sizes = counts.groupBy(*group).agg(F.sum("n").alias("size"))
    asked = F.explode(F.array(*map(F.lit, probabilities))).alias("quantile")
    place = F.col("quantile") * (F.col("size") - 1)
    rows = ranked.join(sizes, group).select("*", asked).withColumn("_at", place)
    # Ranks first..upto-1 (from 0) hold this value; keep it where it covers floor or ceiling.
    first = F.col("upto") - F.col("n")
    holds = lambda rank: (first <= rank) & (rank < F.col("upto"))
    low, high = F.floor("_at"), F.ceil("_at")
    return (rows.where(holds(low) | holds(high)).groupBy(*group, "quantile")
            .agg(F.max(F.when(holds(low), F.col("value"))).alias("_low"),
                 F.max(F.when(holds(high), F.col("value"))).alias("_high"),
                 F.max("_at").alias("_at"))
            .select(*group, "quantile", (F.col("_low") + (F.col("_high") - F.col("_low"))
                                         * (F.col("_at") - F.floor("_at"))).alias("value")))
