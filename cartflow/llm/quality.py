"""Quality by hierarchical empirical Bayes: what a text says, and what its host and path say.

A logistic classifier over counts of the text gives each document evidence (log odds over the prior). Sites
are judged from their documents' labels, or the classifier's probability where there is
none: a host's rate is shrunk toward the global rate, a path's toward its host's, each by a number of pseudo-documents
estimated from how much sites differ beyond chance (method of moments), so sparse sites stay close to
what lies above them. The score is sigmoid(evidence + log odds of the path's rate without the document's own share).

The classifier is fitted on at most ``TRAINING_ROWS`` labelled documents outside the held-out fold; site counts cover
all documents, by grouped aggregation.

Nulls and edge cases: a null text counts as empty; a null host or path is a site of its own; of several
labels of a document the highest counts; labels of the held-out fold are never read; without labelled rows every
document has no evidence and scores the prior of 0.5; repeated rows are scored alike; other columns play no part.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType

from cartflow.llm.common import blocks, fold, stored, text_or_empty
from cartflow.llm.text_stats import FIRST_BYTE, LOWER, UPPER, TextStats, byte_set, distinct_per_text

FOLDS, HELD_OUT = 4, 2
TRAINING_ROWS = 20_000
THRESHOLD = 0.5
_STEPS = 400
_ENDS, _BANGS, _BARS, _COMMAS = byte_set("."), byte_set("!"), byte_set("|"), byte_set(",;:")
N_FEATURES = 12


def _features(texts: list[bytes]) -> np.ndarray:
    stats = TextStats(texts)
    block = stats.block
    begin, end = block.offsets[:-1], block.offsets[1:] - 1
    words = np.maximum(stats.n_words, 1)
    upper, lower = block.count_between(UPPER, begin, end), block.count_between(LOWER, begin, end)

    def rate(flags):
        return np.log1p(10 * block.count_between(flags, begin, end) / words)

    return np.stack([
        np.log1p(stats.n_words), np.log1p(stats.word_chars / words), np.log1p(10 * stats.n_symbols / words),
        stats.n_repeat_words / words, stats.n_dup_lines / np.maximum(stats.n_lines, 1), upper / np.maximum(upper + lower, 1),
        rate(_BANGS), rate(_BARS), rate(_ENDS), rate(_COMMAS),
        distinct_per_text(block.doc, stats.hashes, stats.n) / words,
        block.count_between(FIRST_BYTE, begin, end) / np.maximum(end - begin, 1)], axis=1)


def _with_features(rows: DataFrame, keep: list[str]) -> DataFrame:
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in blocks(batches):
            x = _features(texts)
            bounds = np.arange(len(texts) + 1, dtype=np.int32) * N_FEATURES
            yield pa.RecordBatch.from_arrays(
                [*batch.select(keep).columns, pa.ListArray.from_arrays(pa.array(bounds), pa.array(x.ravel()))],
                names=[*keep, "features"])

    return rows.select(*keep, "text").mapInArrow(run, rows.select(*keep).schema.add("features", ArrayType(DoubleType())))


def fit_logistic(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, float]:
    """Weights by raw feature and intercept, over the log odds of the labels (Newton steps, small ridge)."""
    mean, scale = x.mean(axis=0), x.std(axis=0) + 1e-9
    z = np.column_stack([(x - mean) / scale, np.ones(len(x))])
    ridge = np.append(np.full(x.shape[1], 1.0), 1e-6)
    theta = np.zeros(z.shape[1])
    for _ in range(25):
        p = 1 / (1 + np.exp(-np.clip(z @ theta, -30, 30)))
        g = z.T @ (y - p) - ridge * theta
        theta = theta + np.linalg.solve((z * (p * (1 - p))[:, None]).T @ z + np.diag(ridge), np.clip(g, -1e6, 1e6))
        theta = np.clip(theta, -50, 50)
    weights = theta[:-1] / scale
    prior = np.clip(y.mean(), 1e-6, 1 - 1e-6)
    return weights, float(theta[-1] - weights @ mean - np.log(prior / (1 - prior)))


def _logit(p: Column) -> Column:
    held = F.greatest(F.lit(1e-6), F.least(F.lit(1 - 1e-6), p))
    return F.log(held / (1 - held))


def _sigmoid(z: Column) -> Column:
    return 1 / (1 + F.exp(-z))


def _shrunk(sites: DataFrame, keys: list[str], above: str, name: str) -> DataFrame:
    """Adds ``name``: the site's rate shrunk toward column ``above``, and ``name``_weight, its pseudo-documents.

    With N documents in k sites, the variance between sites is the weighted squared distance from what
    lies above minus what chance explains; pseudo-documents are p (1 - p) / variance - 1.
    """
    moments = sites.agg(
        F.sum("n").alias("N"), F.count(F.lit(1)).alias("k"), F.sum(F.col("n") * F.col("n")).alias("nn"),
        F.sum(F.col("n") * F.pow(F.col("good") / F.col("n") - F.col(above), 2)).alias("spread"),
        F.sum(F.col("n") * F.col(above) * (1 - F.col(above))).alias("inner"))
    row = moments.first()
    variance, inner = 0.0, 0.0
    if row["N"] and row["k"] > 1:
        inner = row["inner"] / row["N"]
        left = row["N"] - row["nn"] / row["N"]
        variance = (row["spread"] - (row["k"] - 1) * inner) / left if left > 0 else 0.0
    weight = inner / variance - 1 if variance > 0 else 1e4
    weight = float(min(max(weight, 1.0), 1e4))
    return sites.withColumn(name, (F.col("good") + weight * F.col(above)) / (F.col("n") + weight)).withColumn(
        f"{name}_weight", F.lit(weight))


def judge(docs: DataFrame, labels: DataFrame, host: str | Column = "source", path: str | Column | None = None,
          rows: int = TRAINING_ROWS, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, host, path, evidence, site_rate, score, kept: one row per document.

    ``path`` is any column; paths of one host share its rate as their starting point.
    """
    host = F.col(host) if isinstance(host, str) else host
    path = (F.lit(None) if path is None else F.col(path) if isinstance(path, str) else path).cast("string")
    named = docs.select(F.col("doc_id").cast("long").alias("doc_id"), host.cast("string").alias("host"),
                        path.alias("path"), text_or_empty().alias("text"))
    known = stored(labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality"))
                   .where(F.col("doc_id").isNotNull() & F.col("quality").isNotNull() & (fold("doc_id", FOLDS) != HELD_OUT))
                   .groupBy("doc_id").agg(F.max("quality").alias("quality")), "known")
    measured = stored(_with_features(named, ["doc_id", "host", "path"]).join(known, "doc_id", "left"), "measured")
    sample = (measured.where(F.col("quality").isNotNull()).orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
              .select("features", "quality").toArrow())
    y = np.asarray(sample["quality"]).astype(float)
    if len(y) and 0 < y.mean() < 1:
        x = np.asarray(sample["features"].combine_chunks().flatten()).reshape(-1, N_FEATURES)
        weights, intercept, prior = *fit_logistic(x, y), float(y.mean())
    else:
        weights, intercept, prior = np.zeros(N_FEATURES), 0.0, 0.5
    evidence = F.lit(intercept)
    for i, w in enumerate(weights.tolist()):
        evidence = evidence + F.lit(w) * F.col("features")[i]
    p = F.coalesce(F.col("quality").cast("double"), _sigmoid(F.col("evidence") + F.lit(float(np.log(prior / (1 - prior))))))
    judged = measured.withColumn("evidence", evidence).withColumn("share", p).drop("features", "quality")
    paths = stored(judged.groupBy("host", "path").agg(F.count(F.lit(1)).alias("n"), F.sum("share").alias("good")), "paths")
    overall = paths.agg(F.sum("good") / F.sum("n")).first()[0]
    hosts = paths.groupBy("host").agg(F.sum("n").alias("n"), F.sum("good").alias("good")).withColumn(
        "global", F.lit(overall if overall is not None else 0.5))
    hosts = _shrunk(hosts, ["host"], "global", "host_rate").select(F.col("host").alias("of_host"), "host_rate")
    below = stored(paths.join(hosts, F.col("host").eqNullSafe(F.col("of_host"))).drop("of_host"), "below")
    sites = stored(_shrunk(below, ["host", "path"], "host_rate", "path_rate").select(
        F.col("host").alias("s_host"), F.col("path").alias("s_path"), "n", "good", "host_rate", "path_rate_weight"), "sites")
    joined = judged.join(sites, F.col("host").eqNullSafe(F.col("s_host")) & F.col("path").eqNullSafe(F.col("s_path")))
    # The document's own share is taken out, so that its label or evidence does not count twice.
    without = ((F.col("good") - F.col("share") + F.col("path_rate_weight") * F.col("host_rate"))
               / (F.col("n") - 1 + F.col("path_rate_weight")))
    return (joined.withColumn("site_rate", without)
            .withColumn("score", _sigmoid(F.col("evidence") + _logit(F.col("site_rate"))))
            .select("doc_id", F.coalesce(fold("doc_id", FOLDS) == HELD_OUT, F.lit(False)).alias("held_out"), "host", "path",
                    "evidence", "site_rate", "score", (F.col("score") >= threshold).alias("kept")))
