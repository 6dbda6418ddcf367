"""Secrets: patterns, and runs of characters that look random rather than written.

Two first-order Markov models of characters are trained on labelled samples of the table itself:
the values that the patterns find (random strings), and all other runs of six or more such characters (ordinary
words and identifiers). Any other run, of whatever length and characters, is a secret if the logarithm of its likelihood
ratio is at least ``LEAST_RATIO`` in all and ``LEAST_RATE`` a character. Counts cover all rows; the models are two small tables of
pair counts. Ratios are whole multiples of 2^-20, so a run's sum does not depend on what is read beside it.

Nulls and edge cases: a null text counts as empty and has no spans; without a single pattern match
every pair is equally likely in the random model; very long texts and runs are scored whole, ties count as secrets; rows are scanned one by one, so repeated rows, null ids and other
columns change nothing; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartflow.llm.common import blocks, id_and_text
from cartflow.llm.words import WordBlock

KINDS = ("assign", "access", "hex")
# About the log-odds of a run that is no secret: one in a million is.
LEAST_RATIO, LEAST_RATE = 14.0, 0.5
_UNIT = 1 << 20
_LEAST_SAMPLE = 6

ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
_N = len(ALPHABET) + 1  # and the edge of a run
_CODE = np.full(256, -1, np.int64)
_CODE[[ord(c) for c in ALPHABET]] = np.arange(len(ALPHABET))
_OUTSIDE = _CODE < 0

# The names that an assigned secret goes by.
_NAMES = ("password", "passwd", "secret", "token", "apikey", "api_key")


def _either_case(name: str) -> str:
    return "".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in name)


_ASSIGN = re.compile("(?:" + "|".join(map(_either_case, _NAMES)) + r""")["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
# A run that is too short at its first match is too short at any later one.
_ACCESS = re.compile(r"AKIA[A-Z0-9]{14,}")
_NO_HEX = np.array([chr(b) not in "0123456789abcdef" for b in range(256)])


def _runs(texts: list[bytes], breaks: np.ndarray, least: int) -> list[tuple[int, int, int]]:
    """(text, start, end) in characters of the longest runs without a break, of ``least`` bytes or more."""
    block = WordBlock(texts, breaks)
    return _in_characters(block, np.flatnonzero(block.ends - block.starts >= least))


def _in_characters(block: WordBlock, chosen: np.ndarray) -> list[tuple[int, int, int]]:
    if not len(chosen):
        return []
    doc = block.doc[chosen]
    points = block.points(np.concatenate([block.offsets[doc], block.starts[chosen], block.ends[chosen]]))
    base, start, end = points.reshape(3, -1)
    return list(zip(doc.tolist(), (start - base).tolist(), (end - base).tolist()))


def find_base(texts: list[bytes]) -> list[list[tuple[str, int, int, int, int]]]:
    """For each text (kind, start, end, value start, value end) of the pattern spans, by start, then kind as listed."""
    spans: list[list[tuple[int, int, int, int, int]]] = [[] for _ in texts]
    for d, a, b in _runs(texts, _NO_HEX, 16):
        spans[d].append((a, 2, b, a, b))
    for d, raw in enumerate(texts):
        lowered = raw.lower()
        if any(name.encode() in lowered for name in _NAMES):
            spans[d] += [(m.start(), 0, m.end(), *m.span(1)) for m in _ASSIGN.finditer(raw.decode())
                         if m.end(1) - m.start(1) >= 12]
        if b"AKIA" in raw:
            spans[d] += [(m.start(), 1, m.end(), *m.span()) for m in _ACCESS.finditer(raw.decode())]
    return [[(KINDS[k], a, b, c, e) for a, k, b, c, e in sorted(found)] for found in spans]


def _pairs(run: str) -> np.ndarray:
    """Codes of the character pairs of a run, its edges included."""
    codes = np.concatenate([[_N - 1], _CODE[np.frombuffer(run.encode("ascii"), np.uint8)], [_N - 1]])
    return codes[:-1] * _N + codes[1:]


def _in_alphabet(value: str) -> str:
    return "".join(c for c in value if c in ALPHABET)


def train(docs: DataFrame) -> np.ndarray:
    """Log-likelihood ratio (random over ordinary) of each pair of characters, from all rows."""
    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        random, ordinary = np.zeros(_N * _N, np.int64), np.zeros(_N * _N, np.int64)
        for _, texts in blocks(batches, block_rows=1 << 20):
            block = WordBlock(texts, _OUTSIDE)
            taken = np.zeros(len(block.data) + 1, np.int64)
            for d, spans in enumerate(find_base(texts)):
                if not spans:
                    continue
                text = texts[d].decode()
                for *_, a, b in spans:
                    run = _in_alphabet(text[a:b])
                    if run:
                        random += np.bincount(_pairs(run), minlength=_N * _N)
                base = int(block.offsets[d])
                for _, a, b, *_ in spans:
                    taken[base + len(text[:a].encode())] += 1
                    taken[base + len(text[:b].encode())] -= 1
            inside = np.concatenate([[0], np.cumsum(np.cumsum(taken) > 0)])
            keep = (block.ends - block.starts >= _LEAST_SAMPLE) & (inside[block.ends] == inside[block.starts])
            starts, ends = block.starts[keep], block.ends[keep]
            first, last = _CODE[block.data[starts]], _CODE[block.data[ends - 1]]
            ordinary += np.bincount((_N - 1) * _N + first, minlength=_N * _N)
            ordinary += np.bincount(last * _N + _N - 1, minlength=_N * _N)
            turn = np.zeros(len(block.data) + 1, np.int64)
            turn[starts] += 1
            turn[ends - 1] -= 1  # the last character of a run begins no pair in it
            begins = np.flatnonzero(np.cumsum(turn)[:-1] > 0)
            ordinary += np.bincount(_CODE[block.data[begins]] * _N + _CODE[block.data[begins + 1]], minlength=_N * _N)
        for label, counts in ((1, random), (0, ordinary)):
            seen = np.flatnonzero(counts)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(seen), label)), pa.array(seen), pa.array(counts[seen])],
                                             names=["label", "pair", "n"])

    # At most two rows for each pair of characters reach the driver.
    rows = (id_and_text(docs).select("text").mapInArrow(count, "label long, pair long, n long")
            .groupBy("label", "pair").agg(F.sum("n").alias("n")).collect())
    models = np.ones((2, _N, _N))
    for label, pair, n in rows:
        models[label].flat[pair] += n
    models /= models.sum(axis=2, keepdims=True)
    return np.rint(np.log(models[1] / models[0]) * _UNIT).astype(np.int64).ravel()


def find_random(texts: list[bytes], ratios: np.ndarray) -> list[tuple[int, int, int]]:
    """(text, start, end) in characters of the runs that the models hold to be random."""
    block = WordBlock(texts, _OUTSIDE)
    if not len(block.starts):
        return []
    code = _CODE[block.data]
    inner = np.where((code[:-1] >= 0) & (code[1:] >= 0), ratios[code[:-1] * _N + code[1:]], 0)
    sums = np.concatenate([[0], np.cumsum(inner)])
    edge = _N - 1
    total = (sums[block.ends - 1] - sums[block.starts] + ratios[edge * _N + code[block.starts]]
             + ratios[code[block.ends - 1] * _N + edge])
    hits = np.flatnonzero((total >= LEAST_RATIO * _UNIT) & (total >= LEAST_RATE * _UNIT * (block.ends - block.starts)))
    return _in_characters(block, hits)


def find(docs: DataFrame, ratios: np.ndarray) -> DataFrame:
    """doc_id, the counts by kind, base_sha256 and spans.

    ``spans`` has the pattern spans and the model's as markov:start:end, by start, then kind (the model's last).
    """
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, texts in blocks(batches):
            found = find_base(texts)
            counts = [[sum(1 for s in spans if s[0] == k) for spans in found] for k in KINDS]
            base = [",".join(f"{k}:{a}:{b}" for k, a, b, *_ in spans) for spans in found]
            every = list(base)
            added: dict[int, list[tuple[int, int]]] = {}
            for d, a, b in find_random(texts, ratios):
                if not any(x < b and a < y for _, x, y, *_ in found[d]):
                    added.setdefault(d, []).append((a, b))
            for d, own in added.items():
                spans = [(a, KINDS.index(k), b) for k, a, b, *_ in found[d]] + [(a, len(KINDS), b) for a, b in own]
                every[d] = ",".join(f"{(*KINDS, 'markov')[k]}:{a}:{b}" for a, k, b in sorted(spans))
            yield pa.RecordBatch.from_arrays(
                [rows.column(0), *[pa.array(c, pa.int64()) for c in counts],
                 pa.array([hashlib.sha256(b.encode()).hexdigest() for b in base]), pa.array(every)],
                names=["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"])

    return id_and_text(docs).mapInArrow(run, "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string")
