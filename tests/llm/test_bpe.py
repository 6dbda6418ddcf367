"""Forced-boundary merging against the published library, and the codec's awkward rows."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from cartflow.llm import bpe_codec
from cartflow.llm.forced_bpe import ForcedBoundaryBpe
from tests.llm import data


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_str(bpe_codec.definition())


@pytest.fixture(scope="module")
def merges():
    return ForcedBoundaryBpe(bpe_codec.definition())


def _same(merges, library, texts):
    tokens = merges.tokens()
    for text, packed in zip(texts, merges.packed([t.encode() for t in texts])):
        ids = np.frombuffer(packed, "<u4").tolist()
        expected = library.encode(text, add_special_tokens=False).ids
        assert ids == expected, text[:80]
        assert " ".join(tokens[i] for i in ids) == library.decode(expected, skip_special_tokens=False)


def test_random_texts_equal_the_library(merges, library):
    rng = random.Random(5)
    parts = [*"abcdest ll'0123!?.#ÉéΣİßÅ각가̧́̈ﬀ\x1c\x85　  \n\t ", "'s", "'ll", "the ", "ing",
             "<|startoftext|>", "<|endoftext|>", "<|", "|>", "🏳️‍🌈"]
    _same(merges, library, ["".join(rng.choices(parts, k=rng.randint(0, 50))) for _ in range(4000)])


def test_every_kind_of_character(merges, library):
    _same(merges, library, [f"a{chr(c)}b́ {chr(c)}" for c in range(0, 0x110000, 7) if not 0xD800 <= c < 0xE000])


def test_long_runs(merges, library):
    _same(merges, library, ["a" * 5000, "ab" * 5000 + "!" * 3000, "ha" * 20_000, "é" * 3000, "<|endoftext|>" * 500, "", " "])


def test_cuts_are_places_no_token_covers(merges):
    names = [t.removesuffix("</w>") for t in merges.tokens()[:49_406]]
    pieces = ["xqzzkthe", "ing", "qjx"]
    ids, starts = merges.fragments(pieces)
    text = "".join(pieces)
    assert len(ids) == len(text) and len(starts) > len(pieces)
    inner = set(starts.tolist()) - {0, 8, 11}
    assert inner and all(not any(text[i - 1:i + 1] in n for n in names) or i in (7, 10, 13) for i in inner)


def test_caches_may_run_full(library, monkeypatch):
    from cartflow.llm import forced_bpe

    monkeypatch.setattr(forced_bpe, "_KEPT_WORDS", 20)
    monkeypatch.setattr(forced_bpe, "_KEPT_PIECES", 10)
    rng, merges = random.Random(2), ForcedBoundaryBpe(bpe_codec.definition())
    for _ in range(20):
        _same(merges, library, [data.text(rng, 3) + "é" for _ in range(3)])


def test_awkward_documents(spark, library):
    docs = data.awkward(spark)
    rows = bpe_codec.decode(bpe_codec.encode(docs, keep=["doc_id", "text"])).collect()
    assert len(rows) == docs.count()
    for row in rows:
        expected = library.encode(row.text or "", add_special_tokens=False).ids
        assert row.ids == expected and row.decoded == library.decode(expected, skip_special_tokens=False)
    packed = bpe_codec.encode(docs, keep=["doc_id", "text"], packed=True).collect()
    assert sorted(np.frombuffer(r.ids, "<u4").tolist() for r in packed) == sorted(r.ids for r in rows)
    assert bpe_codec.decode(bpe_codec.encode(data.empty(spark))).count() == 0


def test_query_equals_the_library(spark, sf_dir, library):
    import hashlib

    from cartflow.llm.queries import QUERIES

    rows = QUERIES["op11_bpe"](spark, sf_dir).collect()
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    assert len(rows) == len(texts)
    for row in rows:
        ids = library.encode(texts[row.doc_id], add_special_tokens=False).ids
        assert row.n_tokens == len(ids)
        assert row.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert row.decoded_sha256 == hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()


def test_ids_and_texts_come_from_one_pass(spark, library):
    """op11 encodes and decodes in the same task: a second Python worker a task took an executor over its memory."""
    docs = data.awkward(spark).where("doc_id IS NOT NULL").union(data.awkward(spark).where("doc_id = 1").withColumn(
        "text", F.lit("a\x00b \x1f del\x7f x y")))
    for packed in (False, True):
        found = bpe_codec.encode(docs, keep=["doc_id", "text"], packed=packed, decoded="decoded")
        assert found._jdf.queryExecution().executedPlan().toString().count("MapInArrow") == 1
        for row in found.collect():
            want = library.encode(row.text or "", add_special_tokens=False).ids
            assert (np.frombuffer(row.ids, "<u4").tolist() if packed else row.ids) == want
            assert row.decoded == library.decode(want, skip_special_tokens=False)
