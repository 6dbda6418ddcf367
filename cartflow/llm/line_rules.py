"""Quality rules, line first: failing lines go, then documents that lost too much.

A line fails when it
* has no sentence punctuation at its end and none inside (menus, headings, tables),
* shouts: most of its letters are capitals, or there is an exclamation mark for every three words,
* is navigation: at least three separators, one for every four words,
* is symbol noise: a tenth of its characters are symbols,
* is boilerplate: it repeats an earlier line of the text, or two of its words (one, in a line below ten
  words) are typical of site notices.
A document is kept if at least ``1 - MOST_LOST`` of its characters in lines with words remain and it passes
the base rule (ten words or more; no more than a fifth of them in repeated windows).

Nulls and edge cases: a null or empty text has no words and fails the base rule; rows are judged one by one, so
repeated rows, null ids and other columns change nothing; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from cartflow.llm.common import blocks, id_and_text
from cartflow.llm.text_stats import FIRST_BYTE, LOWER, SYMBOLS, UPPER, TextStats, byte_set
from cartflow.llm.words import WordBlock

MOST_LOST = 0.5
_INSIDE, _END, _CLOSING = byte_set(".,;:!?"), byte_set(".!?:;"), byte_set("\"')]}*_")
_BANG, _SEPARATOR = byte_set("!"), byte_set("|>")
# Words of site notices.
NOTICE_WORDS = ["cookie", "cookies", "javascript", "copyright", "subscribe", "newsletter", "login", "signup",
                "unsubscribe", "sitemap", "disclaimer", "permalink", "lorem", "ipsum"]

SCHEMA = ("doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
          "base_failed boolean, kept boolean, n_lines long, n_failed_lines long, chars_lost double")


def _notice_hashes() -> np.ndarray:
    return np.sort(WordBlock([w.encode() for w in NOTICE_WORDS]).hashes())


def failing_lines(stats: TextStats, notice: np.ndarray) -> np.ndarray:
    block = stats.block
    words = stats.line_words
    last_word = stats.line_first_word + words - 1
    last = block.data[block.ends[last_word] - 1]
    before = block.data[np.maximum(block.ends[last_word] - 2, 0)]
    ended = _END[last] | (_CLOSING[last] & _END[before])
    bare = ~ended & (stats.lines_flagged(_INSIDE) == 0)
    capitals, small = stats.lines_flagged(UPPER), stats.lines_flagged(LOWER)
    shouted = ((capitals > small) & (capitals >= 10)) | ((3 * stats.lines_flagged(_BANG) >= words) & (words >= 3))
    separators = stats.lines_flagged(_SEPARATOR)
    navigation = (separators >= 3) & (4 * separators >= words)
    noise = 10 * stats.lines_flagged(SYMBOLS) >= stats.lines_flagged(FIRST_BYTE)
    hit = np.isin(block.hashes(fold_case=True), notice)
    hits = np.concatenate([[0], np.cumsum(hit)])
    notices = hits[stats.line_first_word + words] - hits[stats.line_first_word]
    return bare | shouted | navigation | noise | stats.repeated_lines() | (notices >= 2) | ((notices >= 1) & (words < 10))


def judge_lines(docs: DataFrame, most_lost: float = MOST_LOST) -> DataFrame:
    """One row per document: the base counts, base_failed, kept, and what the line rules removed."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        notice = _notice_hashes()
        for rows, texts in blocks(batches):
            stats = TextStats(texts)
            failed = failing_lines(stats, notice)
            size = stats.lines_flagged(FIRST_BYTE)
            all_chars = np.bincount(stats.line_doc, size, minlength=stats.n)
            lost = np.bincount(stats.line_doc[failed], size[failed], minlength=stats.n) / np.maximum(all_chars, 1)
            base = (stats.n_words < 10) | (100 * stats.n_repeat_words > 20 * stats.n_words)
            yield pa.RecordBatch.from_arrays([
                rows.column(0), *[pa.array(x.astype(np.int64)) for x in (
                    stats.n_words, stats.word_chars, stats.n_symbols, stats.n_dup_lines, stats.n_repeat_words)],
                pa.array(base), pa.array(~base & (lost <= most_lost)), pa.array(stats.n_lines.astype(np.int64)),
                pa.array(np.bincount(stats.line_doc[failed], minlength=stats.n).astype(np.int64)), pa.array(lost)],
                names=[f.split()[0] for f in SCHEMA.split(", ")])

    return id_and_text(docs).mapInArrow(run, SCHEMA)


def cleaned(docs: DataFrame) -> DataFrame:
    """doc_id and the text without its failing lines."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        notice = _notice_hashes()
        for rows, texts in blocks(batches):
            stats = TextStats(texts)
            failed = failing_lines(stats, notice)
            kept: list[list[bytes]] = [[] for _ in texts]
            data = stats.block.data.tobytes()
            for d, a, b in zip(*(x[~failed].tolist() for x in (stats.line_doc, stats.line_start, stats.line_end))):
                kept[d].append(data[a:b])
            yield pa.RecordBatch.from_arrays(
                [rows.column(0), pa.array([b"\n".join(k).decode() for k in kept])], names=["doc_id", "text"])

    return id_and_text(docs).mapInArrow(run, "doc_id long, text string")
