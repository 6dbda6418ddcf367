"""Exact deduplication with a heavy-hitter split.

Texts are equal when identical after lower-casing A-Z. A Misra-Gries summary (``approx_top_k``:
a fixed number of counters, lowered together whenever they run out) names digests that may
be frequent; an exact count verifies them, and the verified winners, bounded by the number
of counters, are broadcast, so rows of frequent digests are decided where they are read.
What is left has no frequent digest and is shuffled by digest in the ordinary way.

Nulls and edge cases: a null text counts as empty; empty texts are equal to each other; a
row with a null id loses against any row with an id; of repeated rows (same id, same
text) exactly one stays; other columns play no part.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cartflow.llm.common import fresh, stored, text_or_empty

# At most BUCKETS * TOP digests are broadcast (about 0.5 MB), whatever the size of the input.
BUCKETS, TOP, COUNTERS = 64, 64, 256


def text_digest(text: str = "text") -> Column:
    lowered = F.translate(text_or_empty(text), string.ascii_uppercase, string.ascii_lowercase)
    return F.sha2(lowered, 256)


def digest_table(docs: DataFrame) -> DataFrame:
    """One stored row per document: doc_id, text_sha256 and a row number to tell repeated rows apart."""
    return stored(docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                              text_digest().alias("text_sha256"),
                              F.monotonically_increasing_id().alias("row")), "digests")


def frequent_digests(digests: DataFrame) -> DataFrame:
    """Verified frequent digests with group_size and the row that stays; a bounded number of rows.

    Within a bucket of n rows every digest with more than n / (0.75 * COUNTERS) rows has a
    counter left at the end, so nothing that could fill a task is missed.
    """
    summary = digests.groupBy(F.pmod(F.hash("text_sha256"), F.lit(BUCKETS)).alias("bucket")).agg(
        F.expr(f"approx_top_k(text_sha256, {TOP}, {COUNTERS})").alias("top"))
    named = summary.select(F.explode("top").alias("t")).where("t.count > 1").select(
        F.col("t.item").alias("text_sha256"))
    counted = digests.join(F.broadcast(named), "text_sha256", "left_semi")
    return stored(counted.groupBy("text_sha256").agg(
        F.count(F.lit(1)).alias("group_size"), F.max(_preference()).alias("best"))
        .where("group_size > 1"), "frequent")


def _preference() -> Column:
    """Largest id first, nulls last; of repeated rows the first."""
    return F.struct(F.col("doc_id"), (-F.col("row")).alias("order"))


def copies(docs: DataFrame) -> DataFrame:
    """Every row's verdict: doc_id, keep_id, group_size, kept, text_sha256."""
    digests = digest_table(docs)
    frequent = F.broadcast(frequent_digests(digests))
    group = Window.partitionBy("text_sha256")
    at_once = digests.join(frequent, "text_sha256")
    shuffled = (digests.join(frequent, "text_sha256", "left_anti")
                .withColumn("group_size", F.count(F.lit(1)).over(group))
                .withColumn("best", F.max(_preference()).over(group)))
    return at_once.unionByName(shuffled).select(
        "doc_id", F.col("best.doc_id").alias("keep_id"), "group_size",
        (F.col("best.order") == -F.col("row")).alias("kept"), "text_sha256")


def without_copies(docs: DataFrame) -> DataFrame:
    """The rows of ``docs``, all columns, one of each group of equal texts.

    Copies of frequent texts are removed before the shuffle; of the rest and the winners
    one row per digest passes the group limit.
    """
    digest, best, rank = fresh(docs, "digest"), fresh(docs, "best"), fresh(docs, "rank")
    winners = frequent_digests(digest_table(docs)).select(
        F.col("text_sha256").alias(digest), F.col("best").alias(best))
    first = Window.partitionBy(digest).orderBy(F.col("doc_id").cast("long").desc_nulls_last())
    return (docs.withColumn(digest, text_digest())
            .join(F.broadcast(winners), digest, "left")
            .where(F.col(best).isNull() | F.col(f"{best}.doc_id").eqNullSafe(F.col("doc_id").cast("long")))
            .withColumn(rank, F.row_number().over(first))
            .where(F.col(rank) == 1)
            .select(*[F.col(f"`{c}`") for c in docs.columns]))
