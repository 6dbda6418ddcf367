"""Every operator on nulls, empty and long texts, repeated rows, clashing columns and an empty table."""

import pytest

import corpus_pipeline
from cartflow.llm import (exact_dedup, line_rules, log_bilinear, mixing, near_dedup, pii, piece_codec, quality,
                          secret_scan, toxicity)
from tests.llm import data


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(1, 1, 0), (2, 0, 1), (4, None, None), (None, 1, 1), (3, 1, 0), (3, 0, 0)],
                                 "doc_id long, quality int, toxic int")


def operators(spark, labels):
    return {
        "near": near_dedup.near_duplicates,
        "mixing": mixing.poisson_mixture,
        "codec": piece_codec.encode,
        "quality": lambda d: quality.judge(d, labels, "source", "lang"),
        "exact": exact_dedup.copies,
        "pii": pii.find,
        "rules": line_rules.judge_lines,
        "cleaned": line_rules.cleaned,
        "lm": log_bilinear.score,
        "secrets": lambda d: secret_scan.find(d, secret_scan.train(d)),
        "toxicity": lambda d: toxicity.score(d, toxicity.train(d, labels)),
        "sanitised": pii.sanitise,
    }


NAMES = ["near", "mixing", "codec", "quality", "exact", "pii", "rules", "cleaned", "lm", "secrets", "toxicity", "sanitised"]


@pytest.mark.parametrize("name", NAMES)
def test_awkward_rows(spark, labels, name):
    docs = data.awkward(spark)
    rows = operators(spark, labels)[name](docs).collect()
    if name != "mixing":
        assert sorted(str(r["doc_id"]) for r in rows) == sorted(str(r["doc_id"]) for r in docs.collect())
    if name == "codec":
        assert all(r["round_trip"] for r in rows)
    if name == "toxicity":
        assert all(0 <= r["score"] <= 1 for r in rows)


@pytest.mark.parametrize("name", NAMES)
def test_empty_table(spark, name):
    assert operators(spark, data.no_labels(spark))[name](data.empty(spark)).collect() == []


def test_exact_verdicts(spark):
    rows = exact_dedup.copies(data.awkward(spark)).collect()
    by_id = {r["doc_id"]: r for r in rows if r["doc_id"] is not None}
    assert by_id[1]["keep_id"] == 3 and by_id[3]["kept"] and not by_id[2]["kept"] and by_id[3]["group_size"] == 3
    assert sum(r["kept"] for r in rows if r["doc_id"] == 4) == 1
    assert not any(r["kept"] for r in rows if r["doc_id"] is None)
    assert by_id[6]["kept"] and not by_id[5]["kept"]


@pytest.mark.parametrize("stage", corpus_pipeline.STAGES, ids=lambda s: s[0])
def test_stages_keep_columns(spark, sf_dir, stage):
    docs = data.awkward(spark)
    out = stage[1](spark, docs, sf_dir)
    kept = [str(r["doc_id"]) for r in out.collect()]
    if stage[0] != "sentencepiece":
        assert out.columns == docs.columns
    if stage[0] == "exact_dedup":
        assert sorted(kept) == sorted(["3", "4", "6", "7", "8", "9", "10", "11"])
    if stage[0] == "near_dedup":
        assert sorted(kept) == sorted(["1", "4", "5", "7", "8", "9", "10", "11"])


@pytest.mark.parametrize("stage", corpus_pipeline.STAGES, ids=lambda s: s[0])
def test_stages_on_nothing(spark, sf_dir, stage):
    assert stage[1](spark, data.empty(spark), sf_dir).count() == 0
