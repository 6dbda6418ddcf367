"""Counts over a block of texts that several quality operators share."""

from __future__ import annotations

import numpy as np

from cartflow.llm.words import HASH_BITS, HASH_MASK, SIZE, WordBlock


def byte_set(characters: str) -> np.ndarray:
    flags = np.zeros(256, bool)
    flags[[ord(c) for c in characters]] = True
    return flags


# Fixed value: the characters that count as symbols.
SYMBOLS = byte_set("#*$%&|<>")
FIRST_BYTE = (np.arange(256) & 0xC0) != 0x80
UPPER, LOWER = (byte_set("".join(map(chr, range(a, a + 26)))) for a in (65, 97))


def distinct_per_text(doc: np.ndarray, h: np.ndarray, n: int) -> np.ndarray:
    key = np.sort((doc.astype(np.uint64) << np.uint64(HASH_BITS)) | (h & HASH_MASK))
    new = np.concatenate([[True], key[1:] != key[:-1]]) if len(key) else np.empty(0, bool)
    return np.bincount((key[new] >> np.uint64(HASH_BITS)).astype(np.int64), minlength=n)


class TextStats:
    """Per text: n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words; and the lines with a word."""

    def __init__(self, texts: list[bytes]):
        self.block = block = WordBlock(texts, fold_case=False)
        n = self.n = len(texts)
        begin, end = block.offsets[:-1], block.offsets[1:] - 1
        self.n_words = np.bincount(block.doc, minlength=n)
        chars = np.concatenate([[0], np.cumsum(FIRST_BYTE[block.data])])
        self.word_chars = np.bincount(block.doc, chars[block.ends] - chars[block.starts], minlength=n).astype(np.int64)
        self.n_symbols = block.count_between(SYMBOLS, begin, end)
        self.hashes = block.hashes()
        self.n_repeat_words = self._repeated()
        starts, ends, doc = block.lines()
        words = np.searchsorted(block.starts, starts), np.searchsorted(block.starts, ends)
        some = words[1] > words[0]
        self.line_start, self.line_end, self.line_doc = starts[some], ends[some], doc[some]
        self.line_words = (words[1] - words[0])[some]
        self.line_first_word = words[0][some]
        self.line_hash = block.span_hashes(self.line_start, self.line_end)
        self.n_lines = np.bincount(self.line_doc, minlength=n)
        self.n_dup_lines = self.n_lines - distinct_per_text(self.line_doc, self.line_hash, n)

    def _repeated(self) -> np.ndarray:
        """Words that lie in a window of five words found at least twice in the text."""
        block = self.block
        first, h = block.windows(self.hashes)
        key = (block.doc[first].astype(np.uint64) << np.uint64(HASH_BITS)) | (h & HASH_MASK)
        order = np.argsort(key, kind="stable")
        same = key[order[1:]] == key[order[:-1]] if len(key) else np.empty(0, bool)
        again = np.zeros(len(key), bool)
        again[order[1:][same]] = again[order[:-1][same]] = True
        at = first[again]
        words = len(block.doc)
        turn = np.bincount(at, minlength=words + SIZE) - np.bincount(at + SIZE, minlength=words + SIZE)
        covered = np.cumsum(turn)[:words] > 0
        return np.bincount(block.doc[covered], minlength=self.n)

    def lines_flagged(self, flags: np.ndarray) -> np.ndarray:
        return self.block.count_between(flags, self.line_start, self.line_end)

    def repeated_lines(self) -> np.ndarray:
        """Lines equal to an earlier line of their text."""
        key = (self.line_doc.astype(np.uint64) << np.uint64(HASH_BITS)) | (self.line_hash & HASH_MASK)
        _, first = np.unique(key, return_index=True)
        out = np.ones(len(key), bool)
        out[first] = False
        return out
