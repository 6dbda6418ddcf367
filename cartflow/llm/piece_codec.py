"""SentencePiece encoding and decoding with N-best segmentation, and an exact round trip.

The vocabulary comes from a published model file; nothing is trained. A text is encoded by
the best path through its piece lattice; the next best ones come from a backward A* search with
the forward Viterbi scores as exact heuristics (``pieces``). Spaces become space marks, one mark is
put in front, and a character without a piece becomes its UTF-8 bytes, so decoding gives
back every text exactly, literal space marks and other white space included.

Nulls and edge cases: a null or empty text has no ids, score 0 and no segmentations, and
decodes to the empty text; among equal scores the shorter last piece wins; rows are
handled one by one, so repeated rows, null ids and other columns change nothing.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import StructType

from cartflow.llm.common import blocks, fresh, text_or_empty
from cartflow.llm.pieces import Segments, Vocabulary

MODEL_PATH = "/opt/tokenizers/piece_bpe_32k.model"
N_BEST = 4
_BLOCK = 1 << 20

ENCODED = ("ids array<int>, score double, "
           "n_best array<struct<score: double, edits: array<struct<word: int, ids: array<int>>>>>, round_trip boolean")
_N_BEST_TYPE = pa.list_(pa.struct([("score", pa.float64()), ("edits", pa.list_(pa.struct([
    ("word", pa.int32()), ("ids", pa.list_(pa.int32()))])))]))


def model_bytes(path: str = MODEL_PATH) -> bytes:
    """Read on the driver; tasks get the bytes, so executors need no copy of the file."""
    with open(path, "rb") as file:
        return file.read()


def decoded(bytes_of: list[bytes], ids: list[int]) -> str:
    return b"".join(map(bytes_of.__getitem__, ids))[1:].decode()


def encode(docs: DataFrame, model: bytes | None = None, n: int = N_BEST, keep: list[str] = ("doc_id",)) -> DataFrame:
    """The columns ``keep`` with ids, score, n_best and round_trip.

    ``n_best`` has the scores of the ``n`` best segmentations, best first, and for each the
    words (by place, a word being a run of spaces and what follows it) in which it differs
    from ``ids``, with their ids there. ``round_trip`` says whether ``ids`` decode to the text.
    """
    model = model or model_bytes()
    keep = list(keep)
    text = "text" if "text" not in keep else fresh(docs, "text")
    rows = docs.select(*keep, text_or_empty().alias(text))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = Vocabulary.of(model)
        for batch, raw in blocks(batches, text, _BLOCK):
            texts = [t.decode() for t in raw]
            words = Segments(vocabulary, texts)
            flat, bounds = words.ids()
            cuts = bounds.tolist()
            best = [[{"score": score, "edits": [{"word": w, "ids": ids} for w, ids in edits]}
                     for score, edits in words.n_best(i, n)] for i in range(len(texts))]
            yield pa.RecordBatch.from_arrays(
                [*batch.select(keep).columns,
                 pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(flat)),
                 pa.array([b[0]["score"] if b else 0.0 for b in best]), pa.array(best, _N_BEST_TYPE),
                 pa.array([decoded(vocabulary.bytes_of, flat[a:b].tolist()) == t
                           for a, b, t in zip(cuts[:-1], cuts[1:], texts)])],
                names=[*keep, "ids", "score", "n_best", "round_trip"])

    schema = rows.drop(text).schema
    for field in StructType.fromDDL(ENCODED).fields:
        schema = schema.add(field)
    return rows.mapInArrow(run, schema)


def decode(encoded: DataFrame, model: bytes | None = None, ids: str = "ids", text: str = "text") -> DataFrame:
    """The columns of ``encoded`` other than ``ids``, and the decoded text; null ids give null."""
    bytes_of = Vocabulary.of(model or model_bytes()).bytes_of
    kept = [c for c in encoded.columns if c != ids]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in (batch.slice(i, 200) for i in range(0, batch.num_rows, 200)):
                texts = [None if x is None else decoded(bytes_of, x)
                         for x in part.column(part.schema.get_field_index(ids)).to_pylist()]
                yield pa.RecordBatch.from_arrays([*part.select(kept).columns, pa.array(texts, pa.string())],
                                                 names=[*kept, text])

    return encoded.mapInArrow(run, encoded.drop(ids).schema.add(text, "string"))

