"""Mixing sources to target weights by Poisson replication.

A source's repetition rate is (target share * size of the mixture) / size of the source, in
characters. Each document is repeated k times, k drawn from the Poisson distribution with
that mean by inverting its cumulative distribution at a uniform number hashed from the
document and a seed. Copies are then dealt to partitions, and ordered inside them, by a
hashed position: a global shuffle that needs one exchange and no sampling pass.

Poisson numbers are additive, so a rate above ``PART_RATE`` is drawn as the sum of
equal parts of at most that rate, each with a uniform number of its own; the cumulative
distribution of a part then fits a short array whatever the rate.

Nulls and edge cases: a null source is a source of its own; rows with a null id or text
are drawn like any other (the hash covers both columns); sources without a target get
weight 0 when targets are given; a source without a single character keeps the rate 1;
repeated rows draw the same number of copies; an empty table gives an empty mixture.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartflow.llm.common import fresh, stored, text_or_empty

PART_RATE = 8
# P(more than TERMS events at rate 8) is below 1e-18, less than one step of a double near 1.
TERMS = 48
# Sources are a lookup of one short row each; beyond this many bytes the join shuffles.
BROADCAST_BYTES = 8 << 20


def hashed(*parts: Column) -> Column:
    """52 bits of an MD5 of the parts as a long."""
    text = F.concat_ws("|", *[F.coalesce(p.cast("string"), F.lit("-")) for p in parts])
    return F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("long")


def uniform(*parts: Column) -> Column:
    return (hashed(*parts) + F.lit(0.5)) / F.lit(float(1 << 52))


def source_rates(docs: DataFrame, targets: dict[str, float] | None = None, source: str = "source") -> DataFrame:
    """source, rate, parts and the cumulative distribution of one part.

    Without ``targets`` every source gets the same share of the mixture.
    """
    sizes = docs.groupBy(F.col(source).cast("string").alias("source")).agg(
        F.sum(F.length(text_or_empty()).cast("long")).alias("chars"))
    if targets is None:
        weight = F.lit(1.0)
    else:
        weight = F.lit(0.0)
        for name, value in targets.items():
            weight = F.when(F.col("source").eqNullSafe(F.lit(name)), F.lit(float(value))).otherwise(weight)
    weighed = stored(sizes.select("source", "chars", weight.alias("weight")), "sources")
    total = weighed.agg(F.sum("chars").alias("all_chars"), F.sum("weight").alias("all_weights"))
    rate = F.when(F.col("chars") == 0, F.lit(1.0)).otherwise(
        F.col("weight") * F.col("all_chars") / (F.col("all_weights") * F.col("chars")))
    parts = F.greatest(F.lit(1), F.ceil(F.col("rate") / PART_RATE)).cast("long")
    terms = F.aggregate(
        F.sequence(F.lit(1), F.lit(TERMS)),
        F.struct(F.exp(-F.col("mean")).alias("p"), F.array(F.exp(-F.col("mean"))).alias("cdf")),
        lambda acc, k: F.struct(
            (acc["p"] * F.col("mean") / k).alias("p"),
            F.concat(acc["cdf"], F.array(F.element_at(acc["cdf"], -1) + acc["p"] * F.col("mean") / k)).alias("cdf")),
        lambda acc: acc["cdf"])
    return (weighed.crossJoin(F.broadcast(total))  # one row
            .withColumn("rate", rate).withColumn("parts", parts)
            .withColumn("mean", F.col("rate") / F.col("parts"))
            .select("source", "rate", "parts", terms.alias("cdf")))


def poisson_mixture(docs: DataFrame, targets: dict[str, float] | None = None, seed: int = 0,
                    source: str = "source") -> DataFrame:
    """All columns of ``docs``, each row as often as drawn, with ``copy`` (1, 2, ...) and ``position``.

    ``position`` is the hashed place in the mixture; its order within and across partitions
    is random with respect to the input.
    """
    rates = stored(source_rates(docs, targets, source), "rates")
    size = rates.agg(F.coalesce(F.sum(F.coalesce(F.length("source"), F.lit(0)) + 8 * TERMS), F.lit(0))).first()[0]
    names = {n: fresh(docs, n) for n in ("source_of_rate", "parts", "cdf", "part", "copy", "position", "key")}
    rates = rates.select(F.col("source").alias(names["source_of_rate"]), F.col("parts").alias(names["parts"]),
                         F.col("cdf").alias(names["cdf"]))
    match = docs[source].cast("string").eqNullSafe(rates[names["source_of_rate"]])
    rated = docs.join(F.broadcast(rates) if size <= BROADCAST_BYTES else rates, match)
    document = F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("-")),
                           F.md5(text_or_empty()))
    drawn = (rated.withColumn(names["key"], document)
             .withColumn(names["part"], F.explode(F.sequence(F.lit(1).cast("long"), F.col(names["parts"])))))
    u = uniform(F.lit(seed), F.col(names["key"]), F.col(names["part"]))
    # The uniform number is the start value, so it is computed once and not for each entry.
    count = F.aggregate(
        F.col(names["cdf"]), F.struct(u.alias("u"), F.lit(0).alias("n")),
        lambda acc, c: F.struct(acc["u"].alias("u"), (acc["n"] + (c < acc["u"]).cast("int")).alias("n")),
        lambda acc: acc["n"])
    copied = drawn.withColumn(names["copy"], F.explode(F.when(count > 0, F.sequence(F.lit(1), count))))
    copy = (F.col(names["part"]) - 1) * (TERMS + 1) + F.col(names["copy"])
    placed = copied.select(
        *[F.col(f"`{c}`") for c in docs.columns], copy.alias(names["copy"]),
        hashed(F.lit(f"place {seed}"), F.col(names["key"]), copy).alias(names["position"]))
    return placed.repartition(F.col(names["position"])).sortWithinPartitions(names["position"])
