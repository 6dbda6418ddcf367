"""Byte-pair merges on fragments between forced boundaries.

A merged token stands for neighbouring symbols, so two symbols that are neighbours inside no token of
the vocabulary can never end up in one token: between them lies a certain cut. The fragments between the cuts share
no merge, so each is merged by itself and their ids are put one after the other, which gives the same ids
as merging the whole word. Cuts turn long runs without a space into short fragments.

All fragments of a block are merged side by side in numpy: in each round every fragment has its pair of lowest rank
(the leftmost of equals) merged, until no fragment has a pair left.
"""

from __future__ import annotations

import heapq
import json
import re
from itertools import chain

import numpy as np
from tokenizers import Tokenizer

# Fragments beyond this length are merged one by one with a heap, as a round a merge would cost the square of their length.
_SIDE_BY_SIDE = 64
_KEPT_WORDS, _KEPT_PIECES = 1 << 17, 1 << 16
# White space outside ASCII, in UTF-8.
_WIDE_SPACE = re.compile(rb"\xc2[\x85\xa0]|\xe1\x9a\x80|\xe2\x80[\x80-\x8a\xa8\xa9\xaf]|\xe2\x81\x9f|\xe3\x80\x80")
_PRINTABLE = re.compile(rb"[!-~]+")
_CONTROL = re.compile(rb"[\x00-\x1f\x7f]")
_NONE = np.int64(1) << 30


class ForcedBoundaryBpe:
    """Ids of texts under a published tokenizer definition (JSON) of the merge kind with word ends."""

    def __init__(self, definition: str):
        parsed, library = json.loads(definition), Tokenizer.from_str(definition)
        model = parsed["model"]
        vocabulary, end = model["vocab"], model["end_of_word_suffix"]
        # What cleans and splits a text is taken as published; cutting and merging are done here.
        self._normalise = library.normalizer.normalize_str
        self._split = library.pre_tokenizer.pre_tokenize_str
        self.special = {t["content"]: t["id"] for t in parsed["added_tokens"]}
        self._special = re.compile("|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) or r"(?!)")
        self._special_bytes = re.compile(self._special.pattern.encode())
        self._ascii_piece = re.compile(rb" |" + parsed["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
                                       .replace(r"\s", " ").replace(r"\p{L}", "a-z").replace(r"\p{N}", "0-9").encode())
        self._names = vocabulary
        self._letters(vocabulary, end)
        self._ranks(vocabulary, model["merges"])
        self._words: dict[bytes, bytes] = {}
        self._pieces: dict[str, bytes] = {}

    def _letters(self, vocabulary: dict[str, int], end: str) -> None:
        """The letters of the byte alphabet, their ids inside and at the end of a word, and which may be neighbours."""
        letters = [t for t in vocabulary if len(t) == 1]
        self._place = np.zeros(max(map(ord, letters)) + 1, np.int64)
        self._place[[ord(c) for c in letters]] = range(len(letters))
        self._id_of = np.array([[vocabulary[c], vocabulary[c + end]] for c in letters])
        place = {c: i for i, c in enumerate(letters)}
        self._inside = np.zeros((len(letters), 2, len(letters)), bool)
        for token in vocabulary:
            ends = len(token) > len(end) and token.endswith(end)
            body = [place[c] for c in (token[:-len(end)] if ends else token)]
            for i, (left, right) in enumerate(zip(body, body[1:]), 2):
                self._inside[left, int(ends and i == len(body)), right] = True

    def _ranks(self, vocabulary: dict[str, int], merges: list) -> None:
        pairs = np.array([[vocabulary[a], vocabulary[b], vocabulary[a + b]] for a, b in merges], np.int64)
        keys = pairs[:, 0] << 32 | pairs[:, 1]
        self._rank_of = np.argsort(keys, kind="stable")
        self._pair_keys, self._merged = keys[self._rank_of], pairs[:, 2]

    def tokens(self) -> list[str]:
        """The text of each id."""
        found = {i: t for t, i in chain(self._names.items(), self.special.items())}
        return [found.get(i, "") for i in range(max(found) + 1)]

    def packed(self, texts: list[bytes]) -> list[bytes]:
        """The ids of UTF-8 texts, each as little-endian unsigned 32-bit integers.

        ASCII white space never belongs to a token, and neither composition nor lower-casing reaches
        across it, so the distinct words between are encoded, once.
        """
        words = [t.split() for t in texts]
        new = set(chain.from_iterable(words)).difference(self._words)
        if len(self._words) + len(new) > _KEPT_WORDS:
            self._words = {}
            new = set(chain.from_iterable(words))
        self._words.update(self._encoded(list(new)))
        ids = self._words.__getitem__
        return [b"".join(map(ids, w)) for w in words]

    def _encoded(self, words: list[bytes]) -> dict[bytes, bytes]:
        """Each word's ids: words in pieces, pieces in fragments, fragments merged."""
        plain, wide, odd = [], [], []
        # Most blocks have neither odd strings nor control characters, which one look at all words tells.
        joined = b" ".join(words)
        any_odd = self._special_bytes.search(joined) or _WIDE_SPACE.search(joined)
        printable = _PRINTABLE.fullmatch if _CONTROL.search(joined) else bytes.isascii
        for word in words:
            if any_odd and (self._special_bytes.search(word) or _WIDE_SPACE.search(word)):
                odd.append(word)
            else:
                (plain if printable(word) else wide).append(word)
        pieces = dict(zip(chain(plain, wide), chain(self._ascii_pieces(plain), self._wide_pieces(wide))))
        for word in odd:
            pieces[word] = self._odd_pieces(word.decode())
        needed = set(chain.from_iterable(pieces.values())) - self.special.keys()
        new = needed.difference(self._pieces)
        if len(self._pieces) + len(new) > _KEPT_PIECES:
            self._pieces, new = {}, needed
        self._pieces.update(self._merge_pieces(list(new)))
        special = {s: np.uint32(i).tobytes() for s, i in self.special.items()}
        ids = self._pieces.__getitem__
        # Only words with a special string have one among their pieces.
        found = {word: b"".join(map(ids, pieces[word])) for word in chain(plain, wide)}
        found.update((word, b"".join(special.get(p) or ids(p) for p in pieces[word])) for word in odd)
        return found

    def _ascii_pieces(self, words: list[bytes]) -> list[list[str]]:
        """Printable ASCII words need no composition, and their bytes are their letters."""
        split: list[list[str]] = [[]]
        for piece in self._ascii_piece.findall(b" ".join(words).lower()):
            if piece == b" ":
                split.append([])
            else:
                split[-1].append(piece.decode())
        return split if words else []

    def _wide_pieces(self, words: list[bytes]) -> list[list[str]]:
        """Words without wide white space: cleaned and split in one call, each piece returned to its word."""
        if not words:
            return []
        cleaned = self._normalise(b" ".join(words).decode())
        ends = np.cumsum([len(w) + 1 for w in cleaned.split(" ")])
        found = self._split(cleaned)
        owners = np.searchsorted(ends, [span[0] for _, span in found], "right").tolist()
        split: list[list[str]] = [[] for _ in words]
        for (piece, _), word in zip(found, owners):
            split[word].append(piece)
        return split

    def _odd_pieces(self, word: str) -> list[str]:
        """A word with wide white space or strings of special tokens; a special string is a piece of its own."""
        pieces, start = [], 0
        for hit in [*self._special.finditer(word), None]:
            text = word[start:hit.start() if hit else None]
            pieces += [p for p, _ in self._split(self._normalise(text))] if text else []
            if hit:
                pieces.append(hit.group())
                start = hit.end()
        return pieces

    def fragments(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """First ids of all letters of the pieces, one after the other, and where the fragments begin."""
        place = self._place[np.frombuffer("".join(pieces).encode("utf-32-le"), np.uint32)]
        last = np.zeros(len(place), np.int64)
        last[np.cumsum([len(p) for p in pieces]) - 1] = 1
        joined = self._inside[place[:-1], last[1:], place[1:]] & (last[:-1] == 0)
        return self._id_of[place, last], np.concatenate([[0], np.flatnonzero(~joined) + 1])

    def _merge_pieces(self, pieces: list[str]) -> dict[str, bytes]:
        if not pieces:
            return {}
        ids, starts = self.fragments(pieces)
        merged = self._merge_fragments(ids, starts)
        before = np.concatenate([[0], np.cumsum(merged >= 0)])
        bounds = (4 * before[np.cumsum([0, *map(len, pieces)])]).tolist()
        packed = merged[merged >= 0].astype("<u4").tobytes()
        return {p: packed[a:b] for p, a, b in zip(pieces, bounds, bounds[1:])}

    def _rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        keys = left << 32 | right
        at = np.minimum(np.searchsorted(self._pair_keys, keys), len(self._pair_keys) - 1)
        return np.where(self._pair_keys[at] == keys, self._rank_of[at], _NONE)

    def _merge_fragments(self, ids: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """``ids`` with every merged token at the place of its first letter and -1 at the others."""
        final = np.full(len(ids), -1, np.int64)
        lengths = np.diff(np.append(starts, len(ids)))
        for k in np.flatnonzero(lengths > _SIDE_BY_SIDE).tolist():
            a, b = starts[k], starts[k] + lengths[k]
            final[a:b] = self._heap(ids[a:b].tolist())
        short = lengths <= _SIDE_BY_SIDE
        where = np.flatnonzero(np.repeat(short, lengths))
        ids, lengths = ids[where], lengths[short]
        rank = np.append(self._rank(ids[:-1], ids[1:]), _NONE) if len(ids) else ids
        rank[np.cumsum(lengths) - 1] = _NONE
        while len(lengths):
            starts = np.cumsum(lengths) - lengths
            best = np.minimum.reduceat(rank << 32 | np.arange(len(ids)), starts)
            going = best >> 32 < _NONE
            in_going = np.repeat(going, lengths)
            final[where[~in_going]] = ids[~in_going]
            best = best[going]
            at = best & 0xFFFFFFFF
            ids[at] = self._merged[best >> 32]
            keep = in_going
            keep[at + 1] = False
            place = np.cumsum(keep) - 1
            # The pair that begins with a removed letter passes to its left neighbour, to be looked up again.
            at = place[at]
            ids, where, rank, lengths = ids[keep], where[keep], rank[keep], lengths[going] - 1
            ends = np.zeros(len(ids), bool)
            ends[np.cumsum(lengths) - 1] = True
            changed = np.concatenate([at, at[at > 0] - 1])
            inner = changed[~ends[changed]]
            rank[changed] = _NONE
            rank[inner] = self._rank(ids[inner], ids[inner + 1])
        return final

    def _heap(self, ids: list[int]) -> list[int]:
        """The same merges for one long fragment: a heap of pairs over a linked list."""
        n = len(ids)
        after, before = [*range(1, n + 1)], [*range(-1, n - 1)]
        ranks = self._rank(np.array(ids[:-1]), np.array(ids[1:])).tolist()
        heap = [(rank, left, ids[left], ids[left + 1]) for left, rank in enumerate(ranks) if rank < _NONE]
        heapq.heapify(heap)
        known: dict[tuple[int, int], int] = {}
        while heap:
            rank, left, first, second = heapq.heappop(heap)
            right = after[left]
            if ids[left] != first or right >= n or ids[right] != second:
                continue
            ids[left], ids[right] = int(self._merged[rank]), -1
            after[left] = after[right]
            if after[right] < n:
                before[after[right]] = left
            for a in (before[left], left):
                if a >= 0 and after[a] < n:
                    pair = ids[a], ids[after[a]]
                    if pair not in known:
                        known[pair] = int(self._rank(np.array([pair[0]]), np.array([pair[1]]))[0])
                    if known[pair] < _NONE:
                        heapq.heappush(heap, (known[pair], a, *pair))
        return ids
