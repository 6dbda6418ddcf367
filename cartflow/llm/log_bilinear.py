"""Language-model scores: a log-bilinear neural model over word classes, trained by noise-contrastive estimation.

Classes are the end of a text, the ``TOP`` most frequent words (each alone) and
``GROUPS`` groups of all other words, told apart by their first bytes and length. The model predicts the class of
a token from the two before it: with context vector q = c1 * r(previous) + c2 * r(the one before), a class has
the score q . s(class) + b(class), and one matrix product normalises it over all classes. Inside
a group a word has its smoothed share of the group's training tokens.

Word counts cover all training documents (crc32 of the id modulo 5 is not 1) by grouped aggregation. Training covers all
their tokens as well: training documents are dealt by a hash of id and text to shards of about ``SHARD_TOKENS`` tokens, noise-contrastive
estimation runs in numpy over each shard in a fixed order, and the parameters of all shards are averaged by tokens, for ``ROUNDS`` rounds. So
the model depends on the documents alone, not on how they are spread over tasks; shards grow in number with the table. Counts of words above a share ``SHARE`` of the
tokens (fewer than 1 / SHARE of them) are broadcast; tokens of rarer words meet their counts in a join.

Nulls and edge cases: a null or empty text is its end token alone; a row with a null id belongs to the
training documents; words are told apart by 64-bit hashes; repeated rows are counted and scored one by one; other columns play no part; without
training documents all counts are zero and the class model is uniform.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartflow.llm.common import blocks, fold, id_and_text, stored
from cartflow.llm.words import WordBlock

FOLDS, HELD_OUT = 5, 1
SHARE = 1 / 2_000_000
TOP, GROUPS, WIDTH = 319, 192, 24
CLASSES = 1 + TOP + GROUPS
ROUNDS, BATCH, NOISE, RATE = 2, 4096, 64, 0.08
_CHUNK_TOKENS = 1 << 22
SHARD_TOKENS = 1 << 22
_SHARD_BLOCK = 1 << 20
# Parameters are added as whole multiples of this, so that their sum has no order.
_UNIT = 1 << 16


@dataclass
class Counts:
    """Training tokens N, distinct tokens V, end tokens, and the broadcast part of the word counts."""

    tokens: int
    distinct: int
    ends: int
    hashes: np.ndarray
    counts: np.ndarray
    top: np.ndarray
    top_class: np.ndarray
    group_tokens: np.ndarray
    group_words: np.ndarray

    def lookup(self, h: np.ndarray) -> np.ndarray:
        """Count of each word, or -1 where it is not in the broadcast part."""
        out = np.full(len(h), -1, np.int64)
        if len(self.hashes) and len(h):
            at = np.minimum(np.searchsorted(self.hashes, h), len(self.hashes) - 1)
            hit = self.hashes[at] == h
            out[hit] = self.counts[at[hit]]
        return out


def _groups(block: WordBlock) -> np.ndarray:
    """Group of each word by its first two bytes (A-Z folded) and whether it is long."""
    size = block.ends - block.starts
    first = block.code[block.data[block.starts]].astype(np.int64)
    second = np.where(size > 1, block.code[block.data[np.minimum(block.starts + 1, len(block.data) - 1)]].astype(np.int64), 0)
    return (first * 31 + second * 7 + (size > 7)) % GROUPS


def _word_counts(training: DataFrame) -> DataFrame:
    """word (hash), cls (group), n over all training tokens; word texts never leave their task."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held_h, held_g, size = [], [], 0

        def flush():
            h, first, n = np.unique(np.concatenate(held_h), return_index=True, return_counts=True)
            return pa.RecordBatch.from_arrays([pa.array(h.astype(np.int64)), pa.array(np.concatenate(held_g)[first]),
                                               pa.array(n)], names=["word", "cls", "n"])

        for _, texts in blocks(batches):
            block = WordBlock(texts)
            held_h.append(block.hashes())
            held_g.append(_groups(block))
            size += len(held_h[-1])
            if size >= _CHUNK_TOKENS:
                yield flush()
                held_h, held_g, size = [], [], 0
        if size:
            yield flush()

    return stored(training.select("text").mapInArrow(run, "word long, cls long, n long")
                  .groupBy("word").agg(F.sum("n").alias("n"), F.first("cls").alias("cls")), "words")


def _counts(words: DataFrame, ends: int) -> Counts:
    tokens, distinct = words.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1))).first()
    tokens, distinct = tokens + ends, distinct + (1 if ends else 0)
    # Fewer than 1 / SHARE words can have this many tokens.
    frequent = words.where(F.col("n") >= SHARE * tokens).select("word", "n").toArrow()
    h, n = np.asarray(frequent["word"]).astype(np.uint64), np.asarray(frequent["n"])
    best = words.where(F.col("n") >= SHARE * tokens).orderBy(F.col("n").desc(), "word").limit(TOP).select("word", "n", "cls").collect()
    per_group = words.groupBy("cls").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("words")).collect()
    group_tokens, group_words = np.zeros(GROUPS), np.zeros(GROUPS)
    for r in per_group:
        group_tokens[r["cls"]], group_words[r["cls"]] = r["n"], r["words"]
    for r in best:
        group_tokens[r["cls"]] -= r["n"]
        group_words[r["cls"]] -= 1
    top = np.array([r["word"] for r in best], np.int64).astype(np.uint64)
    by_hash, in_order = np.argsort(h), np.argsort(top)
    return Counts(tokens, distinct, ends, h[by_hash], n[by_hash], top[in_order], in_order + 1, group_tokens, group_words)


class Classes:
    """Token classes of a block of texts, ends included: ``cls``, and (previous, one before) ``context``."""

    def __init__(self, counts: Counts, texts: list[bytes]):
        self.block = block = WordBlock(texts)
        self.hashes = block.hashes()
        self.group = _groups(block)
        word_class = 1 + TOP + self.group
        if len(counts.top):
            at = np.minimum(np.searchsorted(counts.top, self.hashes), len(counts.top) - 1)
            hit = counts.top[at] == self.hashes
            word_class[hit] = counts.top_class[at[hit]]
        self.word_class = word_class
        per_text = np.bincount(block.doc, minlength=len(texts))
        # Words of a text, then its end (class 0).
        self.cls = np.zeros(len(word_class) + len(texts), np.int64)
        self.cls[np.arange(len(word_class)) + block.doc] = word_class
        end = np.cumsum(per_text + 1) - 1
        previous = np.concatenate([[0], self.cls[:-1]])
        earlier = np.concatenate([[0, 0], self.cls[:-2]])[:len(self.cls)]
        earlier[end[:-1] + 1] = 0  # a text begins as after two ends
        self.context = previous * CLASSES + earlier
        self.doc = np.repeat(np.arange(len(texts)), per_text + 1)


class Model:
    """r: class vectors in the context, c: weights of its two places, s: class vectors to predict, b: biases."""

    def __init__(self, flat: np.ndarray):
        n = CLASSES * WIDTH
        self.flat = flat
        self.r, self.s = flat[:n].reshape(CLASSES, WIDTH), flat[n:2 * n].reshape(CLASSES, WIDTH)
        self.c = flat[2 * n:2 * n + 2 * WIDTH].reshape(2, WIDTH)
        self.b = flat[2 * n + 2 * WIDTH:]

    @staticmethod
    def initial(unigram: np.ndarray) -> np.ndarray:
        rng = np.random.default_rng(7)
        vectors = rng.normal(0, 0.1, 2 * CLASSES * WIDTH)
        return np.concatenate([vectors, np.ones(2 * WIDTH), np.log(unigram)]).astype(np.float32)

    def query(self, context: np.ndarray) -> np.ndarray:
        return self.r[context // CLASSES] * self.c[0] + self.r[context % CLASSES] * self.c[1]


def _nce(model: Model, context: np.ndarray, target: np.ndarray, noise: np.ndarray, log_noise: np.ndarray,
         squares: np.ndarray, rng: np.random.Generator) -> None:
    """One step: true tokens against NOISE classes shared by the batch, drawn from the unigram distribution."""
    q = model.query(context)
    drawn = np.searchsorted(noise, rng.random(NOISE)).clip(0, CLASSES - 1)
    scale = np.float32(np.log(NOISE))
    true = np.einsum("ij,ij->i", q, model.s[target]) + model.b[target] - log_noise[target] - scale
    false = q @ model.s[drawn].T + (model.b[drawn] - log_noise[drawn] - scale)
    d_true = 1 / (1 + np.exp(np.clip(true, -30, 30)))
    d_false = -1 / (1 + np.exp(-np.clip(false, -30, 30)))
    g = Model(np.zeros_like(model.flat))
    d_q = d_true[:, None] * model.s[target] + d_false @ model.s[drawn]
    one, two = context // CLASSES, context % CLASSES
    for j in range(WIDTH):
        g.s[:, j] = np.bincount(target, d_true * q[:, j], CLASSES)
        g.r[:, j] = np.bincount(one, d_q[:, j] * model.c[0, j], CLASSES) + np.bincount(two, d_q[:, j] * model.c[1, j], CLASSES)
    np.add.at(g.s, drawn, d_false.T @ q)
    g.b[:] = np.bincount(target, d_true, CLASSES)
    np.add.at(g.b, drawn, d_false.sum(axis=0))
    g.c[0], g.c[1] = (d_q * model.r[one]).sum(axis=0), (d_q * model.r[two]).sum(axis=0)
    step = g.flat / len(target)
    squares += step * step
    model.flat += np.float32(RATE) * step / (np.sqrt(squares) + np.float32(1e-6))


def _trained(training: DataFrame, counts: Counts) -> Model:
    unigram = np.zeros(CLASSES)
    unigram[0] = counts.ends
    unigram[counts.top_class] = counts.lookup(counts.top)
    unigram[1 + TOP:] = counts.group_tokens
    unigram = (unigram + 0.5) / (unigram + 0.5).sum()
    noise, log_noise = np.cumsum(unigram), np.log(unigram).astype(np.float32)
    flat = Model.initial(unigram)

    def fit(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, model, squares, rng, seen = None, None, None, None, 0
        for shard, texts in _shard_blocks(batches):
            if shard != current:
                if seen:
                    yield _weighted(model, seen)
                current, model, squares = shard, Model(flat.copy()), np.full_like(flat, 1e-8)
                rng, seen = np.random.default_rng([11, shard]), 0
            tokens = Classes(counts, texts)
            order = rng.permutation(len(tokens.cls))
            for lo in range(0, len(order), BATCH):
                at = order[lo:lo + BATCH]
                _nce(model, tokens.context[at], tokens.cls[at], noise, log_noise, squares, rng)
            seen += len(order)
        if seen:
            yield _weighted(model, seen)

    def add(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, total = 0, np.zeros(len(flat), np.int64)
        for batch in batches:
            for n, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                seen, total = seen + n, total + np.frombuffer(raw, np.int64)
        if seen:
            yield pa.RecordBatch.from_arrays([pa.array([seen]), pa.array([total.tobytes()])], names=["seen", "total"])

    shards = max(1, -(-counts.tokens // SHARD_TOKENS))
    place = F.xxhash64("doc_id", "text")
    dealt = (training.select(F.pmod(place, F.lit(shards)).alias("shard"), place.alias("place"), "doc_id", "text")
             .repartition(shards, "shard").sortWithinPartitions("shard", "place", "doc_id", "text").select("shard", "text"))
    for _ in range(ROUNDS):
        # One sum a shard, added up by 32 tasks, so that the driver gets 32 rows whatever the number of shards.
        sums = (dealt.mapInArrow(fit, "seen long, total binary").repartition(32)
                .mapInArrow(add, "seen long, total binary").collect())
        if sums:
            flat = (sum(np.frombuffer(r["total"], np.int64) for r in sums) / (_UNIT * sum(r["seen"] for r in sums))).astype(np.float32)
    return Model(flat)


def _shard_blocks(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[int, list[bytes]]]:
    """(shard, texts) of about a megabyte, cut by the shard's own texts whatever lies in the same task."""
    current, held, size = None, [], 0
    for batch in batches:
        for shard, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist()):
            if held and (shard != current or size >= _SHARD_BLOCK):
                yield current, held
                held, size = [], 0
            current = shard
            held.append(text)
            size += len(text) + 1
    if held:
        yield current, held


def _weighted(model: Model, seen: int) -> pa.RecordBatch:
    total = np.rint(model.flat.astype(float) * seen * _UNIT).astype(np.int64)
    return pa.RecordBatch.from_arrays([pa.array([seen]), pa.array([total.tobytes()])], names=["seen", "total"])


class Normalised:
    """log P(class | context); normalisers are computed for the contexts met, a block of them at a time, and kept."""

    def __init__(self, model: Model, present: np.ndarray):
        self.model = model
        self.bias = np.where(present, model.b, -np.inf)
        self.log_z = np.full(CLASSES * CLASSES, np.nan)

    def log_p(self, context: np.ndarray, target: np.ndarray) -> np.ndarray:
        new = np.unique(context[np.isnan(self.log_z[context])])
        for lo in range(0, len(new), 4096):
            part = new[lo:lo + 4096]
            z = self.model.query(part) @ self.model.s.T + self.bias
            most = z.max(axis=1)
            self.log_z[part] = most + np.log(np.exp(z - most[:, None]).sum(axis=1))
        score = np.einsum("ij,ij->i", self.model.query(context), self.model.s[target]) + self.bias[target]
        return score - self.log_z[context]


def score(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score: one row per document.

    ``score`` is the model's log10 probability of the text, ``base_score`` that of smoothed word counts.
    """
    rows = id_and_text(docs).withColumn("held_out", F.coalesce(fold("doc_id", FOLDS) == HELD_OUT, F.lit(False)))
    training = rows.where(~F.col("held_out"))
    words = _word_counts(training)
    counts = _counts(words, training.count())
    model = _trained(training, counts)
    present = np.ones(CLASSES, bool)
    present[1 + len(counts.top):1 + TOP] = False
    total = counts.tokens + 0.5 * (counts.distinct + 1)
    in_group = np.log10(counts.group_tokens + 0.5 * (counts.group_words + 1))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        normalised = Normalised(model, present)
        for batch, texts in blocks(batches):
            tokens = Classes(counts, texts)
            doc, n = tokens.block.doc, len(texts)
            model_part = np.bincount(tokens.doc, normalised.log_p(tokens.context, tokens.cls), minlength=n) / np.log(10)
            grouped = tokens.word_class > TOP
            model_part -= np.bincount(doc[grouped], in_group[tokens.group[grouped]], minlength=n)
            count = counts.lookup(tokens.hashes)
            found = count >= 0
            logs = np.log10(count + 0.5, where=found, out=np.zeros(len(count)))
            size = np.bincount(doc, minlength=n) + 1
            base = np.bincount(doc, logs, minlength=n) + np.log10(counts.ends + 0.5) - size * np.log10(total)
            model_part += np.bincount(doc[grouped], logs[grouped], minlength=n)
            known = np.bincount(doc, found, minlength=n).astype(np.int64) + (1 if counts.ends else 0)
            rare = np.flatnonzero(~found)
            cuts = np.searchsorted(doc[rare], np.arange(n + 1)).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [*batch.select(["doc_id", "held_out", "row"]).columns, pa.array(size), pa.array(known), pa.array(base),
                 pa.array(model_part), pa.ListArray.from_arrays(pa.array(cuts), pa.array(tokens.hashes[rare].astype(np.int64)))],
                names=["doc_id", "held_out", "row", "n_tokens", "n_known", "base_score", "score", "rare"])

    numbered = rows.withColumn("row", F.monotonically_increasing_id())
    scored = stored(numbered.mapInArrow(
        run, "doc_id long, held_out boolean, row long, n_tokens long, n_known long, base_score double, score double, "
             "rare array<long>"), "scored")
    # A word that is not broadcast has fewer than SHARE of the training tokens.
    met = (scored.select("row", F.explode("rare").alias("word")).join(words.select("word", "n"), "word", "left")
           .groupBy("row").agg(F.sum(F.log10(F.coalesce("n", F.lit(0)) + 0.5)).alias("logs"), F.count("n").alias("known")))
    return scored.join(met, "row", "left").select(
        "doc_id", "held_out", "n_tokens", (F.col("n_known") + F.coalesce("known", F.lit(0))).alias("n_known"),
        F.lit(counts.tokens).cast("long").alias("train_tokens"),
        (F.col("base_score") + F.coalesce("logs", F.lit(0.0))).alias("base_score"),
        (F.col("score") + F.coalesce("logs", F.lit(0.0))).alias("score"))
