"""Byte-pair encoding and decoding of whole texts, by merges between forced boundaries (``forced_bpe``).

The vocabulary comes from a published tokenizer definition; nothing is trained. Ids equal those of the published
tokenizer without added start and end tokens; the strings of its special tokens inside a text become their ids.
Decoding gives what that tokenizer's decoder gives: without one, its tokens joined by spaces.

Nulls and edge cases: a null or empty text, and one of white space alone, has no ids and decodes to the empty
text; very long texts, and very long runs without a space, are encoded whole, at a cost in proportion to length (times its
logarithm in a run no boundary cuts); equal ranks merge from the left; rows are handled one by one, so repeated rows,
null ids, other columns and an empty table change nothing.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import ArrayType, BinaryType, IntegerType, StringType, StructField, StructType

from cartflow.llm.common import blocks, fresh, text_or_empty
from cartflow.llm.forced_bpe import ForcedBoundaryBpe

DEFINITION_PATH = "/opt/tokenizers/word_bpe_49k.json"
_ROWS, _BLOCK = 500, 1 << 20


def definition(path: str = DEFINITION_PATH) -> str:
    """Read on the driver; tasks get the text, so executors need no copy of the file."""
    with open(path, encoding="utf-8") as file:
        return file.read()


def _decoded(tokens: list[str], ids: bytes | list[int]) -> str:
    return " ".join(map(tokens.__getitem__, np.frombuffer(ids, "<u4").tolist() if isinstance(ids, bytes) else ids))


def encode(docs: DataFrame, model: str | None = None, keep: list[str] = ("doc_id",), packed: bool = False,
           decoded: str | None = None) -> DataFrame:
    """The columns ``keep`` and ``ids``: an array of int, or with ``packed`` the same as little-endian 32-bit binary.

    ``decoded`` names a further column: the text that ``decode`` gives for the ids, decoded in the same task.
    """
    model = model or definition()
    keep = list(keep)
    text = fresh(docs, "text") if "text" in keep else "text"
    rows = docs.select(*[f"`{c}`" for c in keep], text_or_empty().alias(text))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        merges = ForcedBoundaryBpe(model)
        tokens = merges.tokens() if decoded else []
        for batch, raw in blocks(batches, text, _BLOCK):
            found = merges.packed(raw)
            ids = pa.array(found, pa.binary())
            back = [pa.array([_decoded(tokens, x) for x in found], pa.string())] if decoded else []
            if not packed:
                bounds = np.frombuffer(ids.buffers()[1], np.int32)[ids.offset:ids.offset + len(ids) + 1] // 4
                flat = np.frombuffer(b"".join(found), np.int32)
                ids = pa.ListArray.from_arrays(pa.array(bounds - bounds[0]), pa.array(flat))
            yield pa.RecordBatch.from_arrays([*batch.select(keep).columns, ids, *back],
                                             names=[*keep, "ids", *([decoded] if decoded else [])])

    kind = BinaryType() if packed else ArrayType(IntegerType())
    more = [StructField(decoded, StringType())] if decoded else []
    return rows.mapInArrow(run, StructType([*rows.schema.fields[:-1], StructField("ids", kind), *more]))


def decode(encoded: DataFrame, model: str | None = None, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """All columns of ``encoded`` and the decoded text; ``ids`` may be packed; null ids give null."""
    tokens = ForcedBoundaryBpe(model or definition()).tokens()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in (batch.slice(i, _ROWS) for i in range(0, batch.num_rows, _ROWS)):
                column = part.column(part.schema.get_field_index(ids))
                texts = [None if x is None else _decoded(tokens, x) for x in column.to_pylist()]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(texts, pa.string())],
                                                 names=[*part.schema.names, text])

    return encoded.mapInArrow(run, StructType([*encoded.schema.fields, StructField(text, StringType())]))
