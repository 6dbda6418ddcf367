"""Inverse document frequency of word shingles, with the exact document count of every shingle.

Texts are packed in blocks. Each block asks for the counts of its distinct shingles: their sorted hashes go to as many
buckets of the hash range as the input needs, every bucket adds up what the blocks have and answers each of them, in the order asked.
A block joined with its answers knows the count of each shingle of its texts, so nothing is held whole in one
place: a bucket and a block are of bounded size, and a shingle of every text is one number a block in its bucket.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartflow.llm.common import BLOCK_ROWS, blocks, stored
from cartflow.llm.words import HASH_BITS, WordBlock

# A block of texts, and about as many bytes of text a bucket of shingles answers for.
BLOCK_BYTES, BUCKET_BYTES = 1 << 21, 1 << 24
# Blocks of a row group of the stored blocks: Spark decodes a row group's texts at once, and bounds it by its compressed bytes.
BLOCKS_OF_ROW_GROUP = 8
# A shingle that every document has still weighs this much, so that two copies of a text
# do not drift apart by a changed word because the rest of it is common.
LEAST_WEIGHT = 0.5
PACKED = "block long, bytes long, worded long, doc_id array<long>, node array<binary>, row array<long>, text array<string>"


@dataclass
class Idf:
    """Sorted hashes of shingles and their weights; every other shingle weighs 1, like one of a single document."""

    hashes: np.ndarray
    weights: np.ndarray

    def of(self, h: np.ndarray) -> np.ndarray:
        out = np.ones(len(h))
        if len(self.hashes) and len(h):
            at = np.minimum(np.searchsorted(self.hashes, h), len(self.hashes) - 1)
            found = self.hashes[at] == h
            out[found] = self.weights[at[found]]
        return out


def weights(counts: np.ndarray, docs: int) -> np.ndarray:
    """1 for a shingle of one document of ``docs``, ``LEAST_WEIGHT`` for one of all, by the logarithm of the count between."""
    idf = np.log(docs / counts) / np.log(max(docs, 2))
    return LEAST_WEIGHT + (1 - LEAST_WEIGHT) * idf


def pack(numbers: np.ndarray) -> bytes:
    """Unsigned numbers, the bytes of equal value side by side, compressed."""
    if not len(numbers):
        return b""
    return pa.compress(np.ascontiguousarray(numbers).view(np.uint8).reshape(len(numbers), -1).T.tobytes(), "zstd", asbytes=True)


def unpack(packed: bytes, n: int, kind: type) -> np.ndarray:
    size = np.dtype(kind).itemsize
    flat = pa.decompress(packed, n * size, "zstd", asbytes=True) if n else b""
    return np.ascontiguousarray(np.frombuffer(flat, np.uint8).reshape(size, n).T).view(kind).ravel()


def packed_texts(numbered: DataFrame) -> DataFrame:
    """The rows of ``numbered`` (doc_id, node, row, text) in stored blocks, with their bytes and number of texts with a word."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, texts in blocks(batches, "text", BLOCK_BYTES):
            one = [pa.ListArray.from_arrays(pa.array([0, rows.num_rows], pa.int32()), c) for c in rows.columns]
            yield pa.RecordBatch.from_arrays(
                [pa.array([sum(map(len, texts))]), pa.array([len(np.unique(WordBlock(texts).doc))]), *one],
                names=["bytes", "worded", *rows.schema.names])

    packed = numbered.select("doc_id", "node", "row", "text").mapInArrow(run, PACKED.removeprefix("block long, "))
    return stored(packed.select(F.monotonically_increasing_id().alias("block"), "*"), "blocks", compression="zstd",
                  **{"parquet.block.row.count.limit": str(BLOCKS_OF_ROW_GROUP)})


def _totals(h: np.ndarray, here: np.ndarray) -> np.ndarray:
    """For each entry the sum of ``here`` over the entries of equal ``h``, 2^32 - 1 at most."""
    order = np.argsort(h, kind="stable").astype(np.uint32 if len(h) < 1 << 32 else np.int64)
    one = h[order]
    first = np.ones(len(one), bool)
    np.not_equal(one[1:], one[:-1], out=first[1:])
    del one
    new = np.flatnonzero(first)
    total = np.minimum(np.add.reduceat(here[order], new, dtype=np.int64), 0xFFFFFFFF).astype(np.uint32)
    del new
    counts = np.empty(len(order), np.uint32)
    number = np.cumsum(first, dtype=np.uint32 if len(h) < 1 << 32 else np.int64)
    number -= 1
    counts[order] = total[number]
    return counts


def shingle_counts(packed: DataFrame) -> DataFrame:
    """block, bucket, n and counts: how many documents have each shingle of a block, in the order of the hashes."""
    size = packed.agg(F.sum("bytes")).first()[0] or 0
    bits = max(0, int(np.ceil(np.log2(max(size, 1) / BUCKET_BYTES))))

    def ask(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, texts in zip(batch.column(0).to_pylist(), batch.column(1)):
                _, h, _ = WordBlock(texts.values.cast(pa.binary()).to_pylist()).shingle_sets()
                h, n = np.unique(h, return_counts=True)
                ids, begin = np.unique(h >> np.uint64(HASH_BITS - bits), return_index=True)
                ends = [*begin.tolist()[1:], len(h)]
                parts = [(h[a:b], n[a:b].astype(np.uint32)) for a, b in zip(begin.tolist(), ends)]
                yield pa.RecordBatch.from_arrays([
                    pa.array([block] * len(ids), pa.int64()), pa.array(ids.astype(np.int64)),
                    pa.array([len(x) for x, _ in parts], pa.int64()),
                    pa.array([pack(np.diff(x, prepend=np.uint64(0))) for x, _ in parts], pa.binary()),
                    pa.array([pack(y) for _, y in parts], pa.binary())], names=["block", "bucket", "n", "hashes", "counts"])

    def answer(asked: pa.Table) -> pa.Table:
        sizes = asked.column("n").to_pylist()
        h, here = np.empty(sum(sizes), np.uint64), np.empty(sum(sizes), np.uint32)
        at = 0
        for n, x, y in zip(sizes, asked.column("hashes"), asked.column("counts")):
            np.cumsum(unpack(x.as_py(), n, np.uint64), out=h[at:at + n])
            here[at:at + n] = unpack(y.as_py(), n, np.uint32)
            at += n
        counts = _totals(h, here)
        ends = np.cumsum(sizes).tolist()
        return asked.select(["block", "bucket", "n"]).append_column(
            "counts", pa.array([pack(counts[b - n:b]) for b, n in zip(ends, sizes)], pa.binary()))

    asked = packed.select("block", "text").mapInArrow(
        ask, "block long, bucket long, n long, hashes binary, counts binary")
    return stored(asked.groupBy("bucket").applyInArrow(answer, "block long, bucket long, n long, counts binary"), "counts")


def with_counts(packed: DataFrame) -> DataFrame:
    """The blocks, each with ``answers``: its shingles' counts by bucket."""
    answers = shingle_counts(packed).groupBy("block").agg(
        F.array_sort(F.collect_list(F.struct("bucket", "n", "counts"))).alias("answers"))
    return packed.join(answers, "block", "left")


def counts_of(h: np.ndarray, answers: list[dict] | None) -> np.ndarray:
    """The count of each shingle of a block's texts from the block's answers."""
    if not answers:
        return np.empty(0, np.uint32)
    known = np.concatenate([unpack(a["counts"], a["n"], np.uint32) for a in answers])
    _, at = np.unique(h, return_inverse=True)
    return known[at]


def idf_of(texts: list[bytes], counts: list[bytes], docs: int) -> Idf:
    """The weights of the shingles of ``texts``, of which ``counts`` has the packed counts in the order of their hashes."""
    found, known = [np.empty(0, np.uint64)], [np.empty(0, np.uint32)]
    for start in range(0, len(texts), BLOCK_ROWS):
        doc, h, _ = WordBlock(texts[start:start + BLOCK_ROWS]).shingle_sets()
        sizes = np.bincount(doc, minlength=min(BLOCK_ROWS, len(texts) - start)).tolist()
        found.append(h)
        known += [unpack(c, n, np.uint32) for c, n in zip(counts[start:start + BLOCK_ROWS], sizes)]
    hashes, first = np.unique(np.concatenate(found), return_index=True)
    return Idf(hashes, weights(np.concatenate(known)[first], docs))
