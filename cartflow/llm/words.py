"""Words and word shingles of a block of texts as numpy arrays.

A word is a run of bytes other than space and \\x09-\\x0D (all of them ASCII, so UTF-8 bytes
and characters agree), or of letters where ``NO_LETTER`` is given. Hashes cover whole words,
A-Z lower-cased unless ``fold_case`` is off.
"""

from __future__ import annotations

import numpy as np

SIZE = 5
HASH_BITS = 54
HASH_MASK = np.uint64((1 << HASH_BITS) - 1)
_CHUNK = 1 << 20
_BASE, _STEP = 0x9E3779B97F4A7C15, np.uint64(0xD6E8FEB86659FD93)

IS_SPACE = np.zeros(256, bool)
IS_SPACE[[0x20, *range(0x09, 0x0E)]] = True
# Breaks between runs of letters; bytes from 0x80 belong to letters beyond ASCII.
NO_LETTER = np.array([not (chr(b).isalpha() or b >= 0x80) for b in range(256)])
_AS_IS = np.arange(256, dtype=np.uint64) + np.uint64(1)
_LOWER = _AS_IS.copy()
_LOWER[65:91] += np.uint64(32)


def mix(h: np.ndarray) -> np.ndarray:
    """Finish a 64-bit hash so that all bits depend on all bits."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _powers(base: int, n: int) -> np.ndarray:
    steps = np.full(n, base, np.uint64)
    steps[0] = 1
    return np.cumprod(steps, dtype=np.uint64)


_UP, _DOWN = _powers(_BASE, 2 * _CHUNK), _powers(pow(_BASE, -1, 1 << 64), 2 * _CHUNK)


class WordBlock:
    """``starts``/``ends`` (byte offsets in ``data``) and ``doc`` (index of the text) of every word.

    Texts lie one after the other in ``data``, each followed by a newline; ``offsets`` are
    their first bytes.
    """

    def __init__(self, texts: list[bytes], breaks: np.ndarray = IS_SPACE, fold_case: bool = True):
        self.n = len(texts)
        self.code = _LOWER if fold_case else _AS_IS
        self.data = np.frombuffer(b"\n".join([*texts, b""]), np.uint8)
        sizes = np.fromiter(map(len, texts), np.int64, self.n)
        self.offsets = np.concatenate([[0], np.cumsum(sizes + 1)])
        space = breaks[self.data]
        turns = np.flatnonzero(space[1:] != space[:-1]) + 1
        if len(space) and not space[0]:
            turns = np.concatenate([[0], turns])
        self.starts, self.ends = turns[0::2], turns[1::2]
        self.doc = np.searchsorted(self.offsets, self.starts, "right") - 1

    def hashes(self, fold_case: bool | None = None) -> np.ndarray:
        return self.span_hashes(self.starts, self.ends, self.code if fold_case is None else _LOWER if fold_case else _AS_IS)

    def span_hashes(self, starts: np.ndarray, ends: np.ndarray, code: np.ndarray | None = None) -> np.ndarray:
        """64-bit hash of each span (in order, not crossing): a polynomial in its bytes, from running sums."""
        out = np.empty(len(starts), np.uint64)
        cuts = np.searchsorted(starts, np.arange(0, len(self.data) + _CHUNK, _CHUNK))
        for lo, hi in zip(cuts[:-1], cuts[1:]):
            if lo == hi:
                continue
            s, e = starts[lo:hi], ends[lo:hi]
            first, size = s[0], e[-1] - s[0]
            up, down = (_UP, _DOWN) if size < len(_UP) else (
                _powers(_BASE, size + 1), _powers(pow(_BASE, -1, 1 << 64), size + 1))
            total = np.zeros(size + 1, np.uint64)
            np.cumsum((self.code if code is None else code)[self.data[first:e[-1]]] * up[:size], out=total[1:])
            out[lo:hi] = (total[e - first] - total[s - first]) * down[s - first]
        return mix(out + (ends - starts).astype(np.uint64))

    def lines(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """First byte, end and text of every line (texts are split at newlines)."""
        ends = np.flatnonzero(self.data == 0x0A)
        starts = np.concatenate([[0], ends[:-1] + 1]) if len(ends) else ends
        return starts, ends, np.searchsorted(self.offsets, starts, "right") - 1

    def count_between(self, flags: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """How many bytes of each span have their flag set; ``flags`` has 256 entries."""
        total = np.concatenate([[0], np.cumsum(flags[self.data])])
        return total[ends] - total[starts]

    def points(self, at: np.ndarray) -> np.ndarray:
        """Byte offsets in ``data`` as characters from the beginning of ``data``."""
        return np.concatenate([[0], np.cumsum((self.data & 0xC0) != 0x80)])[at]

    def windows(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index of the first word and hash of each window of five words of one text."""
        if len(hashes) < SIZE:
            return np.empty(0, np.int64), np.empty(0, np.uint64)
        first = np.flatnonzero(self.doc[:-SIZE + 1] == self.doc[SIZE - 1:])
        h = hashes[first]
        for i in range(1, SIZE):
            h = h * _STEP + hashes[first + i]
        return first, mix(h)

    def shingle_sets(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(text, hash of 54 bits, occurrences) of each distinct shingle of each text, in that order.

        A text of one to four words has one shingle: all of its words.
        """
        assert self.n <= 1 << (64 - HASH_BITS)
        hashes = self.hashes()
        first, h = self.windows(hashes)
        doc = self.doc[first]
        short = np.bincount(self.doc, minlength=self.n)[self.doc] < SIZE if len(self.doc) else np.empty(0, bool)
        if short.any():
            own, words = self.doc[short], hashes[short]
            begin = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]]))
            place = np.arange(len(own)) - np.repeat(begin, np.diff(np.append(begin, len(own))))
            whole = np.add.reduceat(words * mix(place.astype(np.uint64) + _STEP), begin)
            doc, h = np.concatenate([doc, own[begin]]), np.concatenate([h, mix(whole)])
        key = np.sort((doc.astype(np.uint64) << np.uint64(HASH_BITS)) | (h & HASH_MASK))
        new = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.empty(0, np.int64)
        times = np.diff(np.append(new, len(key)))
        key = key[new]
        return (key >> np.uint64(HASH_BITS)).astype(np.int64), key & HASH_MASK, times
