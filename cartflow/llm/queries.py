"""The corpus operators as named queries, with oracle SQL where SQL can express them."""

from __future__ import annotations

import string
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartflow.llm import (bpe_codec, exact_dedup, line_rules, log_bilinear, mixing, near_dedup, pii, piece_codec,
                          prefix_trie, quality, secret_scan, toxicity, whitening)
from cartflow.llm.common import conversations, documents, embeddings, labels

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    def register(function):
        QUERIES[name] = function
        if oracle:
            ORACLES[name] = oracle
        return function
    return register


def mixture_sql(docs: str, columns: str, seed: int = 0) -> str:
    """DuckDB SQL of ``poisson_mixture`` with equal targets over the relation ``docs``."""
    def number(text: str) -> str:
        return f"CAST('0x' || substr(md5({text}), 1, 13) AS BIGINT)"
    return f"""
sizes AS (SELECT source, sum(length(coalesce(text, '')))::BIGINT AS chars FROM {docs} GROUP BY source),
totals AS (SELECT sum(chars)::BIGINT AS all_chars, count(*)::DOUBLE AS all_weights FROM sizes),
rates AS (SELECT source, CASE WHEN chars = 0 THEN 1.0::DOUBLE
                              ELSE 1.0::DOUBLE * all_chars / (all_weights * chars) END AS rate FROM sizes, totals),
parted AS (SELECT source, greatest(1, ceil(rate / {mixing.PART_RATE}))::BIGINT AS parts,
                  rate / greatest(1, ceil(rate / {mixing.PART_RATE})) AS mean FROM rates),
terms AS (SELECT source, 0 AS k, exp(-mean) AS p, exp(-mean) AS c, mean FROM parted
          UNION ALL
          SELECT source, k + 1, p * mean / (k + 1), c + p * mean / (k + 1), mean FROM terms WHERE k < {mixing.TERMS}),
keyed AS (SELECT d.*, coalesce(d.doc_id::VARCHAR, '-') || ':' || md5(coalesce(d.text, '')) AS key_, r.parts
          FROM {docs} d JOIN parted r ON d.source IS NOT DISTINCT FROM r.source),
drawn AS (SELECT *, unnest(range(1, parts + 1)) AS part FROM keyed),
numbered AS (SELECT *, ({number(f"'{seed}|' || key_ || '|' || part::VARCHAR")} + 0.5::DOUBLE) / {1 << 52}::DOUBLE AS u
             FROM drawn),
counted AS (SELECT n.*, (SELECT count(*) FROM terms t WHERE t.source IS NOT DISTINCT FROM n.source AND t.c < n.u) AS times
            FROM numbered n),
copied AS (SELECT *, (part - 1) * {mixing.TERMS + 1} + unnest(range(1, times + 1)) AS copy FROM counted),
mixture AS (SELECT {columns}, copy,
                   {number(f"'place {seed}|' || key_ || '|' || copy::VARCHAR")} AS position FROM copied)"""


EXACT_SQL = f"""
digests AS (SELECT *, sha256(translate(coalesce(text, ''), '{string.ascii_uppercase}', '{string.ascii_lowercase}'))
            AS text_sha256 FROM documents)"""


@query("op5_exact_dedup", f"""
WITH {EXACT_SQL}
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
       doc_id = max(doc_id) OVER g AS kept, text_sha256
FROM digests WINDOW g AS (PARTITION BY text_sha256)""")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.copies(documents(spark, sf_dir))


@query("op2_mixing", f"""
WITH RECURSIVE {mixture_sql('documents', 'doc_id, text, lang, source, n_chars')}
SELECT doc_id, text, lang, source, n_chars, copy, position FROM mixture""")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.poisson_mixture(documents(spark, sf_dir))


@query("op1_minhash_near_dedup")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(documents(spark, sf_dir))


@query("op3_sentencepiece")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    encoded = piece_codec.encode(documents(spark, sf_dir))
    return encoded.select("doc_id", "ids", F.size("ids").cast("long").alias("n_pieces"), "score",
                          F.col("n_best.score").alias("n_best_scores"), "round_trip")


@query("op4_quality_classifier")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return quality.judge(docs, labels(spark, sf_dir), "source", F.concat_ws("/", "source", "lang"))


@query("op6_pii")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find(documents(spark, sf_dir))
    return found.select("doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", pii.all_spans().alias("spans"))


@query("op7_quality_rules")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_rules.judge_lines(documents(spark, sf_dir))


@query("op8_lm_scoring")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return log_bilinear.score(documents(spark, sf_dir))


@query("op9_secret_scans")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return secret_scan.find(docs, secret_scan.train(docs))


@query("op10_toxicity")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return toxicity.score(docs, toxicity.train(docs, labels(spark, sf_dir))).select(
        "doc_id", "held_out", "score", "predicted",
        F.concat_ws(",", F.transform("sentences", lambda s: F.concat(
            s["start"].cast("string"), F.lit(":"), s["end"].cast("string")))).alias("toxic_sentences"))


@query("op11_bpe")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    encoded = bpe_codec.encode(documents(spark, sf_dir), packed=True, decoded="decoded")
    return encoded.select("doc_id", F.floor(F.octet_length("ids") / 4).alias("n_tokens"),
                          F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


@query("op12_whitening")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    grid = whitening.on_grid(embeddings(spark, sf_dir))
    model = whitening.fit(grid)
    return whitening.by_component(whitening.transform(grid, model), model)


@query("op13_prefix_trie")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = prefix_trie.digested_turns(conversations(spark, sf_dir))
    return prefix_trie.trie(*prefix_trie.rebuilt_turns(turns))
