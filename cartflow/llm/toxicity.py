"""Toxicity by multiple-instance learning: sentence scores combined by noisy-or.

A document is a bag of sentences of which at least one is toxic if the document is. A
sentence scores p = sigmoid(bias + sum of the weights of the features it has: its words, and
their first four and five bytes), and the document 1 - prod(1 - p). Weights are trained from document labels
only, through the noisy-or, so that they find the sentences that explain the label.

Training reads at most ``TRAINING_ROWS`` labelled documents, the ones with the least hash of their id, and keeps the
``FEATURES`` features that separate the labels best, if they do so by ``LEAST_STRENGTH`` standard deviations. Ids, languages and sources are
not features.

Nulls and edge cases: a null or empty text has no sentence and scores 0; labels that are null are
not used, of several labels of a document the highest counts; without labelled rows every
text scores 0; rows are scored one by one, so repeated rows and other columns change nothing; a row with a
null id is scored and is not held out.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartflow.llm.common import blocks, fold, fresh, id_and_text, text_or_empty
from cartflow.llm.words import NO_LETTER, WordBlock

FOLDS, HELD_OUT = 4, 2
THRESHOLD = 0.3
TRAINING_ROWS = 20_000
FEATURES = 8192
LEAST_DOCUMENTS, LEAST_STRENGTH = 3, 5.0
_PREFIXES = (4, 5)
_STEPS, _RATE, _DECAY = 300, 0.1, 1e-5
_STOP = np.zeros(256, bool)
_STOP[[ord(c) for c in ".!?\n"]] = True


@dataclass
class Model:
    """Sorted feature hashes with their weights, and the bias of a sentence."""

    features: np.ndarray = field(default_factory=lambda: np.empty(0, np.uint64))
    weights: np.ndarray = field(default_factory=lambda: np.empty(0))
    bias: float = -np.inf


class Sentences:
    """Sentences of a block of texts: ``doc``, byte span, and (sentence, feature hash) pairs."""

    def __init__(self, texts: list[bytes]):
        self.block = block = WordBlock(texts, NO_LETTER)
        stops = np.cumsum(_STOP[block.data])
        mark = stops[block.starts]
        new = np.flatnonzero(np.concatenate([[True], mark[1:] != mark[:-1]])) if len(mark) else np.empty(0, np.int64)
        self.doc = block.doc[new]
        self.n = len(new)
        last = np.append(new[1:], len(mark)) - 1
        self.start, self.end = block.starts[new], block.ends[last] if self.n else block.ends
        self.of_word = np.cumsum(np.bincount(new, minlength=len(mark))) - 1 if self.n else new

    def features(self) -> tuple[np.ndarray, np.ndarray]:
        block = self.block
        sentence, h = [self.of_word], [block.hashes()]
        for k in _PREFIXES:
            long = np.flatnonzero(block.ends - block.starts >= k)
            sentence.append(self.of_word[long])
            h.append(block.span_hashes(block.starts[long], block.starts[long] + k) + np.uint64(k))
        return np.concatenate(sentence), np.concatenate(h)


def _known(model: Model, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which hashes are features of the model, and their places in it."""
    if not len(model.features) or not len(h):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    at = np.minimum(np.searchsorted(model.features, h), len(model.features) - 1)
    hit = np.flatnonzero(model.features[at] == h)
    return hit, at[hit]


def _sentence_pairs(found: Sentences, model: Model) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (sentence, feature place) pairs."""
    sentence, h = found.features()
    hit, at = _known(model, h)
    pair = np.unique(sentence[hit].astype(np.int64) * max(len(model.features), 1) + at)
    return pair // max(len(model.features), 1), pair % max(len(model.features), 1)


def sentence_scores(found: Sentences, model: Model) -> np.ndarray:
    sentence, at = _sentence_pairs(found, model)
    z = model.bias + np.bincount(sentence, model.weights[at], minlength=found.n)
    return 1 / (1 + np.exp(-np.clip(z, -60, 60))) if np.isfinite(model.bias) else np.zeros(found.n)


def noisy_or(doc: np.ndarray, p: np.ndarray, n: int) -> np.ndarray:
    return -np.expm1(np.bincount(doc, np.log1p(-np.minimum(p, 1 - 1e-12)), minlength=n))


def training_rows(docs: DataFrame, labels: DataFrame, rows: int = TRAINING_ROWS) -> DataFrame:
    """text and toxic of at most ``rows`` labelled documents outside the held-out fold."""
    known = (labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
             .where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & (fold("doc_id", FOLDS) != HELD_OUT))
             .groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
             .orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows))
    # Bounded by ``rows``.
    return id_and_text(docs).join(F.broadcast(known), "doc_id").select("text", "toxic")


def train(docs: DataFrame, labels: DataFrame, rows: int = TRAINING_ROWS) -> Model:
    marked = training_rows(docs, labels, rows)

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in blocks(batches, block_bytes=8 << 20):
            toxic = np.asarray(batch.column(1))
            found = Sentences(texts)
            sentence, h = found.features()
            pair = np.unique(np.stack([found.doc[sentence].astype(np.uint64), h]), axis=1)
            order = np.argsort(pair[1], kind="stable")
            h, bad = pair[1][order], toxic[pair[0][order].astype(np.int64)]
            new = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]])) if len(h) else np.empty(0, np.int64)
            n = np.diff(np.append(new, len(h)))
            yield pa.RecordBatch.from_arrays(
                [pa.array(h[new].astype(np.int64)), pa.array(n),
                 pa.array(np.add.reduceat(bad.astype(np.int64), new) if len(h) else n)], names=["h", "n", "bad"])

    sizes = marked.groupBy("toxic").count().collect()
    n_bad = sum(r["count"] for r in sizes if r["toxic"] == 1)
    n_all = sum(r["count"] for r in sizes)
    if not n_bad or n_bad == n_all:
        return Model()
    rate = n_bad / n_all
    expected = F.col("n") * rate
    # How many standard deviations the toxic documents with a feature differ from chance.
    strength = F.abs(F.col("bad") - expected) / F.sqrt(expected * (1 - rate))
    best = (marked.mapInArrow(count, "h long, n long, bad long").groupBy("h").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
            .where((F.col("n") >= LEAST_DOCUMENTS) & (strength >= LEAST_STRENGTH)).orderBy(strength.desc(), "h").limit(FEATURES).select("h").collect())
    model = Model(np.sort(np.array([r[0] for r in best], np.int64).astype(np.uint64)))

    def bags(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """For each document its label, its sentences without features, and its (sentence, feature) pairs."""
        for batch, texts in blocks(batches):
            found = Sentences(texts)
            sentence, at = _sentence_pairs(found, model)
            with_any = np.unique(sentence)
            bare = np.bincount(found.doc, minlength=len(texts)) - np.bincount(found.doc[with_any], minlength=len(texts))
            cuts = np.searchsorted(found.doc[sentence], np.arange(len(texts) + 1)).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [batch.column(1), pa.array(bare.astype(np.int64)),
                 pa.ListArray.from_arrays(pa.array(cuts), pa.array(sentence)),
                 pa.ListArray.from_arrays(pa.array(cuts), pa.array(at))], names=["toxic", "bare", "sentence", "at"])

    bagged = marked.mapInArrow(bags, "toxic int, bare long, sentence array<long>, at array<long>").toArrow()
    return _fit(bagged, model, rate)


def _fit(bagged: pa.Table, model: Model, rate: float) -> Model:
    y = np.asarray(bagged["toxic"]).astype(float)
    bare = np.asarray(bagged["bare"]).astype(float)
    lists = bagged["sentence"].combine_chunks()
    doc = np.repeat(np.arange(len(y)), np.diff(np.asarray(lists.offsets)))
    number = np.asarray(lists.flatten())
    at = np.asarray(bagged["at"].combine_chunks().flatten())
    new = np.concatenate([[True], (doc[1:] != doc[:-1]) | (number[1:] != number[:-1])]) if len(doc) else np.empty(0, bool)
    sentence = np.cumsum(new) - 1
    of_doc = doc[new]
    n = len(of_doc)
    theta = np.zeros(len(model.features) + 1)
    sentences_each = max((bare.sum() + n) / max(len(y), 1), 1)
    theta[-1] = np.log(rate / sentences_each)
    first, second = np.zeros_like(theta), np.zeros_like(theta)
    for step in range(1, _STEPS + 1):
        z = np.clip(theta[-1] + np.bincount(sentence, theta[at], minlength=n), -30, 30)
        p, p0 = 1 / (1 + np.exp(-z)), 1 / (1 + np.exp(-np.clip(theta[-1], -30, 30)))
        clean = np.bincount(of_doc, np.log1p(-p), minlength=len(y)) + bare * np.log1p(-p0)
        clean = np.minimum(clean, -1e-12)
        # Gradient of the log-likelihood by log P(clean): -y P(clean) / P(toxic) + (1 - y); by z: times -p.
        by_clean = (1 - y) - y * np.exp(clean) / -np.expm1(clean)
        by_z = -p * by_clean[of_doc]
        g = np.zeros_like(theta)
        g[:-1] = np.bincount(at, by_z[sentence], minlength=len(theta) - 1)
        g[-1] = by_z.sum() - (by_clean * bare).sum() * p0
        g = g / len(y) - _DECAY * theta
        first, second = 0.9 * first + 0.1 * g, 0.999 * second + 0.001 * g * g
        theta += _RATE * (first / (1 - 0.9 ** step)) / (np.sqrt(second / (1 - 0.999 ** step)) + 1e-8)
    return Model(model.features, theta[:-1], float(theta[-1]))


def score(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score, predicted, and the sentences that score ``threshold`` or more.

    ``sentences`` has their character spans (end exclusive) and scores.
    """
    where = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64())]))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, texts in blocks(batches):
            found = Sentences(texts)
            p = sentence_scores(found, model)
            total = noisy_or(found.doc, p, len(texts))
            spans: list[list[dict]] = [[] for _ in texts]
            bad = np.flatnonzero(p >= threshold)
            if len(bad):
                base = found.block.points(found.block.offsets[found.doc[bad]])
                start, end = found.block.points(found.start[bad]) - base, found.block.points(found.end[bad]) - base
                for d, s, e, x in zip(found.doc[bad].tolist(), start.tolist(), end.tolist(), p[bad].tolist()):
                    spans[d].append({"start": s, "end": e, "score": x})
            yield pa.RecordBatch.from_arrays(
                [rows.column(0), pa.array(total), pa.array((total >= threshold).astype(np.int32)), pa.array(spans, where)],
                names=["doc_id", "score", "predicted", "sentences"])

    scored = id_and_text(docs).mapInArrow(run, "doc_id long, score double, predicted int, "
                                               "sentences array<struct<start: long, end: long, score: double>>")
    return scored.select("doc_id", F.coalesce(fold("doc_id", FOLDS) == HELD_OUT, F.lit(False)).alias("held_out"),
                         "score", "predicted", "sentences")


def without_toxic(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs``, all columns, that score below ``threshold``."""
    text = fresh(docs, "text_")
    place = len(docs.columns)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # A block at a time, so a task holds the scores' working arrays of one block beside its rows.
        for rows, texts in blocks(batches, text):
            found = Sentences(texts)
            clean = noisy_or(found.doc, sentence_scores(found, model), len(texts)) < threshold
            yield rows.select(range(place)).filter(pa.array(clean))

    return docs.select("*", text_or_empty().alias(text)).mapInArrow(run, docs.schema)
