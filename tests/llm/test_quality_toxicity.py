"""Site rates and noisy-or training against plain Python."""

from __future__ import annotations

import math
import re
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from cartflow.llm import quality, toxicity
from cartflow.llm.words import NO_LETTER, WordBlock


def _sigmoid(z):
    return 1 / (1 + math.exp(-z))


def _logit(p):
    p = min(max(p, 1e-6), 1 - 1e-6)
    return math.log(p / (1 - p))


def _weight(sites):
    """Pseudo-documents of sites (n, good, rate above): p (1 - p) over the variance between sites, less one."""
    total = sum(n for n, _, _ in sites)
    if len(sites) < 2:
        return 1e4
    inside = sum(n * a * (1 - a) for n, _, a in sites) / total
    spread = sum(n * (good / n - a) ** 2 for n, good, a in sites)
    left = total - sum(n * n for n, _, _ in sites) / total
    between = (spread - (len(sites) - 1) * inside) / left if left > 0 else 0.0
    return min(max(inside / between - 1 if between > 0 else 1e4, 1.0), 1e4)


def test_thousands_of_sparse_sites(spark):
    """Hosts of one page beside one with a third of all; scores of every document from plain sums."""
    sites = F.when(F.col("id") % 3 == 0, F.lit("hot")).when(F.col("id") % 41 == 0, None).otherwise(
        F.concat(F.lit("h"), F.pmod(F.xxhash64("id"), F.lit(900)).cast("string")))
    docs = spark.range(6000).select(
        F.col("id").alias("doc_id"), sites.alias("host"),
        F.concat_ws("/", sites, F.pmod(F.xxhash64("id", F.lit(1)), F.lit(5)).cast("string")).alias("path"),
        F.when(F.col("id") % 5 < 2, "BUY now!!! $$$ click | here | now").when(F.col("id") % 5 == 2, "").otherwise(
            F.concat(F.lit("A calm sentence about rivers, number "), F.col("id").cast("string"), F.lit("."))).alias("text"))
    labels = docs.where("doc_id % 4 != 1").select(
        "doc_id", F.when(F.col("doc_id") % 5 < 2, F.col("doc_id") % 7 == 0).otherwise(F.col("doc_id") % 9 != 0).cast("int").alias("quality"))
    got = {r.doc_id: r for r in quality.judge(docs, labels, "host", "path").collect()}
    known = {r.doc_id: r.quality for r in labels.collect() if zlib.crc32(str(r.doc_id).encode()) % quality.FOLDS != quality.HELD_OUT}
    prior = sum(known.values()) / len(known)
    where = {r.doc_id: (r.host, r.path) for r in docs.select("doc_id", "host", "path").collect()}
    share = {d: float(known[d]) if d in known else _sigmoid(r.evidence + math.log(prior / (1 - prior))) for d, r in got.items()}
    path, host = defaultdict(lambda: [0, 0.0]), defaultdict(lambda: [0, 0.0])
    for d, s in share.items():
        for sums in (path[where[d]], host[where[d][0]]):
            sums[0] += 1
            sums[1] += s
    everywhere = sum(share.values()) / len(share)
    w_host = _weight([(n, good, everywhere) for n, good in host.values()])
    host_rate = {h: (good + w_host * everywhere) / (n + w_host) for h, (n, good) in host.items()}
    w_path = _weight([(n, good, host_rate[key[0]]) for key, (n, good) in path.items()])
    assert len(got) == 6000 and len(host) > 800 and len(path) > 2000
    for d, r in got.items():
        n, good = path[where[d]]
        rate = (good - share[d] + w_path * host_rate[where[d][0]]) / (n - 1 + w_path)
        assert (r.host, r.path) == where[d] and r.site_rate == pytest.approx(rate, abs=1e-9)
        assert r.score == pytest.approx(_sigmoid(r.evidence + _logit(rate)), abs=1e-9)


def test_site_of_one_document_has_the_rate_above_it(spark):
    """A page seen once says nothing of itself beyond its own label, which is taken out."""
    docs = spark.createDataFrame([(i, f"h{i}", f"h{i}/a", "Some words here.") for i in range(40)], "doc_id long, host string, path string, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)], "doc_id long, quality int")
    rates = {r.doc_id: r for r in quality.judge(docs, labels, "host", "path").collect()}
    assert all(0 < r.site_rate < 1 for r in rates.values())


_MODEL_WORDS = {"awful": 2.5, "calm": -1.5, "nasty": 3.0}


def _model():
    h = np.concatenate([WordBlock([w.encode()], NO_LETTER).hashes() for w in _MODEL_WORDS])
    order = np.argsort(h)
    return toxicity.Model(h[order], np.array(list(_MODEL_WORDS.values()))[order], -3.0)


@pytest.mark.parametrize("text", ["", "awful", "all is calm. nothing here! awful nasty", "nasty nasty nasty",
                                  "calm calm awful?! one\ntwo nasty calm", ". . .", "plain words only", "awful. " * 300])
def test_noisy_or_is_the_product_over_sentences(spark, text):
    sentences = [s for s in re.split("[.!?\n]+", text) if s.split()]
    p = [_sigmoid(-3.0 + sum(_MODEL_WORDS.get(w, 0.0) for w in set(s.split()))) for s in sentences]
    found = toxicity.Sentences([text.encode()])
    scores = toxicity.sentence_scores(found, _model())
    assert scores == pytest.approx(p, abs=1e-12)
    assert toxicity.noisy_or(found.doc, scores, 1)[0] == pytest.approx(1 - math.prod(1 - x for x in p), abs=1e-9)


def test_training_follows_the_gradient_of_the_noisy_or_likelihood(monkeypatch):
    """The same steps with a gradient taken by differences of the plain log-likelihood."""
    # Label, sentences as lists of feature places; sentences without features are bare.
    bags = [(1, [[0, 1], [2]]), (1, [[0], []]), (0, [[1], [1, 2], []]), (0, [[2]]), (1, [[0, 2]]), (0, [[], []]), (1, [[]])]
    monkeypatch.setattr(toxicity, "_STEPS", 40)

    def likelihood(theta):
        total = 0.0
        for y, sentences in bags:
            clean = min(sum(math.log(1 - _sigmoid(theta[-1] + sum(theta[f] for f in s))) for s in sentences), -1e-12)
            total += math.log(-math.expm1(clean)) if y else clean
        return total / len(bags) - toxicity._DECAY / 2 * float(theta @ theta)

    rate = sum(y for y, _ in bags) / len(bags)
    theta = np.zeros(4)
    theta[-1] = math.log(rate / (sum(len(s) for _, s in bags) / len(bags)))
    first, second = np.zeros(4), np.zeros(4)
    for step in range(1, 41):
        g = np.array([(likelihood(theta + d) - likelihood(theta - d)) / 2e-6 for d in 1e-6 * np.eye(4)])
        first, second = 0.9 * first + 0.1 * g, 0.999 * second + 0.001 * g * g
        theta = theta + toxicity._RATE * (first / (1 - 0.9 ** step)) / (np.sqrt(second / (1 - 0.999 ** step)) + 1e-8)
    pairs = [[(k, f) for k, s in enumerate(sentences) for f in s] for _, sentences in bags]
    table = pa.table({"toxic": pa.array([y for y, _ in bags], pa.int32()),
                      "bare": pa.array([sum(not s for s in sentences) for _, sentences in bags], pa.int64()),
                      "sentence": pa.array([[k for k, _ in p] for p in pairs], pa.list_(pa.int64())),
                      "at": pa.array([[f for _, f in p] for p in pairs], pa.list_(pa.int64()))})
    found = toxicity._fit(table, toxicity.Model(np.arange(3, dtype=np.uint64)), rate)
    assert [*found.weights, found.bias] == pytest.approx(theta.tolist(), abs=1e-4)


def test_the_filter_keeps_whole_rows_and_needs_no_row_queue(spark):
    """Rows pass block by block: no scalar function beside a queue of waiting rows; columns and nulls stay."""
    hashes = toxicity.Sentences([b"vile"]).features()[1]
    model = toxicity.Model(np.sort(np.unique(hashes)), np.full(len(np.unique(hashes)), 9.0), -6.0)
    docs = spark.createDataFrame([(1, "a vile text", "en"), (2, "a fine text", None), (3, None, "de"), (None, "", "fr"), (2, "a fine text", None)],
                                 "doc_id long, text string, lang string")
    kept = toxicity.without_toxic(docs, model)
    assert kept.schema == docs.schema
    assert sorted(map(str, kept.collect())) == sorted(map(str, docs.where("doc_id is null or doc_id != 1").collect()))
    assert "ArrowEvalPython" not in kept._jdf.queryExecution().executedPlan().toString()
