"""The piece lattice of a SentencePiece vocabulary: Viterbi over many words at once, A* for N-best.

No piece has a space mark after another character, so a text is a chain of independent
words (space marks and what follows them) and its lattice a chain of word lattices. Each
distinct word of a block is solved once, all of them together, one position at a time:
words are numbered by falling length, so those that reach a position lie first and side by side there.
Words of more than ``_LONG`` characters have lists of edges instead and are solved one by one.
"""

from __future__ import annotations

import functools
import heapq
import itertools
from collections.abc import Iterator, Sequence

import numpy as np

from cartflow.llm.words import _powers, mix

MARK = 0x2581
# A literal space mark in a text is no space: it matches no piece and becomes bytes.
LITERAL_MARK = 0x110000
_LONG = 48
_BASE = 0x9E3779B97F4A7C15
_FILTER_BITS = 20

# Edges into each position of a word: (start, score, code).
Lattice = list[list[tuple[int, float, int]]]


class Vocabulary:
    """Pieces with their ids, scores and hashes, read from a SentencePiece model file's bytes.

    The stored scores of a BPE model are merge ranks and not log-probabilities. ``log_rank``
    turns rank r into the log of 1 / (r + 2.7) normalised over the pieces (Zipf-Mandelbrot),
    which makes a whole word likelier than a chain of short frequent pieces.
    """

    def __init__(self, model: bytes, log_rank: bool = True):
        import sentencepiece

        processor = sentencepiece.SentencePieceProcessor(model_proto=model)
        n = processor.get_piece_size()
        self.byte_ids = np.zeros(256, np.int32)
        self.bytes_of: list[bytes] = [b""] * n
        ids, points, scores = [], [], []
        for i in range(n):
            piece = processor.id_to_piece(i)
            if processor.is_byte(i):
                value = int(piece[1:-1], 16)
                self.byte_ids[value] = i
                self.bytes_of[i] = bytes([value])
            elif not (processor.is_unknown(i) or processor.is_control(i) or processor.is_unused(i)):
                self.bytes_of[i] = piece.replace(chr(MARK), " ").encode()
                ids.append(i)
                points.append([ord(c) for c in piece])
                scores.append(processor.get_score(i))
        ids, scores = np.array(ids, np.int32), np.array(scores)
        if log_rank:
            rank = np.empty(len(scores))
            rank[np.lexsort((ids, -scores))] = np.arange(1, len(scores) + 1)
            scores = -np.log(rank + 2.7)
            scores -= np.log(np.exp(scores).sum())
        # Multiples of 2^-20 add up without rounding, so that equal paths have equal bounds in the search.
        scores = np.round(scores * (1 << 20)) / (1 << 20)
        self.unknown = float(scores.min() - 10)
        self.longest = max(map(len, points))
        keys = np.empty(len(points), np.uint64)
        sizes = np.fromiter(map(len, points), np.int64, len(points))
        for size in np.unique(sizes):
            some = np.flatnonzero(sizes == size)
            keys[some] = _point_hashes(np.array([points[i] for i in some], np.uint64))
        order = np.argsort(keys)
        self.keys, self.ids, self.scores = keys[order], ids[order], scores[order]
        # Scores by place in ``keys``; at place -1 (no piece) nothing, at place -2 (a character without a piece) the least.
        self.score_at = np.concatenate([self.scores, [self.unknown, -np.inf]])
        # By the first bits of a hash: whether a key begins with them, and the place of the first that does.
        bits = (self.keys >> np.uint64(64 - _FILTER_BITS)).astype(np.int64)
        self.maybe = np.zeros(1 << _FILTER_BITS, bool)
        self.maybe[bits] = True
        new, count = np.unique(bits, return_index=True, return_counts=True)[1:]
        self.first = np.zeros(1 << _FILTER_BITS, np.int32)
        self.first[bits[new]] = new
        self.alike = int(count.max())

    @classmethod
    @functools.lru_cache(1)
    def of(cls, model: bytes) -> Vocabulary:
        """Kept for the next task of the same worker."""
        return cls(model)

    def find(self, h: np.ndarray) -> np.ndarray:
        """Place in ``keys`` of each hash, or -1."""
        out = np.full(len(h), -1, np.int32)
        bits = (h >> np.uint64(64 - _FILTER_BITS)).view(np.int64)
        some = np.flatnonzero(self.maybe[bits])
        at, h = self.first[bits[some]], h[some]
        for _ in range(self.alike):
            hit = self.keys[at] == h
            out[some[hit]] = at[hit]
            miss = np.flatnonzero(~hit)
            some, h, at = some[miss], h[miss], np.minimum(at[miss] + 1, len(self.keys) - 1)
        return out


def _point_hashes(points: np.ndarray) -> np.ndarray:
    """The hash of each row of code points."""
    return mix((points * _powers(_BASE, points.shape[1])).sum(1, dtype=np.uint64) + np.uint64(points.shape[1]))


class _Sums:
    """Hashes of any substrings of an array of code points."""

    def __init__(self, points: np.ndarray):
        n = len(points)
        self.total = np.zeros(n + 1, np.uint64)
        np.cumsum(points * _powers(_BASE, max(n, 1))[:n], out=self.total[1:])
        self.down = _powers(pow(_BASE, -1, 1 << 64), max(n, 1))

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.total[end] - self.total[start]) * self.down[start] + (end - start).astype(np.uint64))


def _codes(v: Vocabulary, found: np.ndarray, points: np.ndarray) -> np.ndarray:
    """The id of each found piece; where there is none, -1 less the character."""
    return np.where(found >= 0, v.ids[found], -1 - np.where(points == LITERAL_MARK, MARK, points).astype(np.int32))


def _ids_of(v: Vocabulary, code: int) -> list[int]:
    return [code] if code >= 0 else v.byte_ids[list(chr(-1 - code).encode())].tolist()


class _ShortWords:
    """Words of up to ``_LONG`` characters, by falling length.

    Arrays of position s have an entry for each word of s characters or more. ``found[s][w - 1]`` is the place in the
    vocabulary of the piece of w characters that ends there (-1: none; -2: a character without a piece).
    """

    def __init__(self, v: Vocabulary, points: np.ndarray, starts: np.ndarray, length: np.ndarray):
        self.v, self.n = v, len(length)
        self.reach = np.searchsorted(-length, -np.arange(length[0] + 1 if self.n else 1), "right").tolist()
        self.points = [points[starts[:n] + (s - 1)] if s else points[:0] for s, n in enumerate(self.reach)]
        self._find()
        self._solve()

    def _find(self) -> None:
        up, down = _powers(_BASE, _LONG + 1), _powers(pow(_BASE, -1, 1 << 64), _LONG + 1)
        total = [np.zeros(self.n, np.uint64)]
        self.found: list[np.ndarray] = [np.empty((0, self.n), np.int32)]
        for s, n in enumerate(self.reach[1:], 1):
            total.append(total[-1][:n] + self.points[s] * up[s - 1])
            widths = range(1, min(s, self.v.longest) + 1)
            h = np.empty((len(widths), n), np.uint64)
            for w in widths:
                h[w - 1] = (total[s] - total[s - w][:n]) * down[s - w] + np.uint64(w)
            found = self.v.find(mix(h).ravel()).reshape(h.shape)
            found[0, found[0] < 0] = -2
            self.found.append(found)

    def _solve(self) -> None:
        self.forward = [np.zeros(self.n)]
        width = [np.empty(0, np.int8)]
        for s, n in enumerate(self.reach[1:], 1):
            value = self.v.score_at[self.found[s]]
            for w in range(1, len(value) + 1):
                value[w - 1] += self.forward[s - w][:n]
            best, by = value[0].copy(), np.ones(n, np.int8)
            for w in range(2, len(value) + 1):
                # The first of equals, so the shortest piece.
                better = value[w - 1] > best
                np.maximum(best, value[w - 1], out=best)
                by[better] = w
            self.forward.append(best)
            width.append(by)
        self.score, second = np.empty(self.n), np.full(self.n, -np.inf)
        ends = [*self.reach[1:], 0]
        # From the last position back: the best that can still come, and whether the best path goes through.
        self.rest = rest = [np.full(n, -np.inf) for n in self.reach]
        on_path = [np.zeros(n, bool) for n in self.reach]
        rows, codes = [], []
        for s in range(len(self.reach) - 1, 0, -1):
            n = self.reach[s]
            self.score[ends[s]:n] = self.forward[s][ends[s]:]
            rest[s][ends[s]:], on_path[s][ends[s]:] = 0, True
            value = self.v.score_at[self.found[s]] + rest[s]
            through = np.where(on_path[s], width[s], 0)
            for w in range(1, len(value) + 1):
                before = rest[s - w][:n]
                np.maximum(before, value[w - 1], out=before)
                value[w - 1] += self.forward[s - w][:n]
                own = through == w
                value[w - 1, own] = -np.inf
                on_path[s - w][:n] |= own
            np.maximum(second[:n], value.max(axis=0), out=second[:n])
            at = np.flatnonzero(on_path[s])
            rows.append(at)
            codes.append(_codes(self.v, self.found[s][width[s][at] - 1, at], self.points[s][at]))
        self.loss = self.score - second
        self.rows, self.codes = (np.concatenate(x[::-1]) if x else np.empty(0, np.int64) for x in (rows, codes))

    def lattices(self, words: np.ndarray, least: np.ndarray) -> Iterator[tuple[Lattice, list[float]]]:
        """Of each of some words (in order): edges into each position, and the best score of a path up to there.

        Edges on no path of at least the score ``least`` are left out.
        """
        rows, ends, widths, found, points, before = [], [], [], [], [], []
        for s, n in enumerate(self.reach):
            own = words[:np.searchsorted(words, n)]
            before.append(self.forward[s][own].tolist())
            at = self.found[s][:, own]
            best = self.v.score_at[at] + (self.rest[s][own] if s else 0)
            for w in range(1, len(best) + 1):
                best[w - 1] += self.forward[s - w][own]
            row, width = np.nonzero(((at != -1) & (best >= least[:len(own)])).T)
            rows.append(row)
            ends.append(np.full(len(row), s))
            widths.append(width)
            found.append(at[width, row])
            points.append(self.points[s][own[row]] if s else self.points[0])
        rows, ends, widths, found, points = map(np.concatenate, (rows, ends, widths, found, points))
        # By word, end and width.
        order = np.argsort(rows, kind="stable")
        ends, found = ends[order], found[order]
        edges = zip(ends.tolist(), (ends - 1 - widths[order]).tolist(), self.v.score_at[found].tolist(),
                    _codes(self.v, found, points[order]).tolist())
        for k, n in enumerate(np.bincount(rows, minlength=len(words)).tolist()):
            scores = [column[k] for column in before if k < len(column)]
            into: Lattice = [[] for _ in scores]
            for end, start, score, code in itertools.islice(edges, n):
                into[end].append((start, score, code))
            yield into, scores


class _LongWords:
    """Words of more than ``_LONG`` characters, with lists of edges."""

    def __init__(self, v: Vocabulary, points: np.ndarray, starts: np.ndarray, length: np.ndarray):
        self.v, self.length = v, length
        n = len(length)
        # Words side by side; word u has nodes node0[u] ... node0[u] + length[u].
        char0 = np.cumsum(length) - length
        self.points = points[np.repeat(starts - char0, length) + np.arange(length.sum())]
        self.node0 = char0 + np.arange(n)
        self._edges(char0)
        self.forward, rest = np.zeros(len(self.points) + n), np.zeros(len(self.points) + n)
        by_word = np.argsort(self.e_word, kind="stable")
        self.of_word = by_word, np.searchsorted(self.e_word[by_word], np.arange(n + 1))
        paths = [self._solve(u, rest) for u in range(n)]
        path = np.array([e for p in paths for e in p], np.int64)
        through = self.forward[self.e_from] + self.e_score + rest[self.e_to]
        through[path] = -np.inf
        second = np.full(n, -np.inf)
        np.maximum.at(second, self.e_word, through)
        self.score = self.forward[self.node0 + length]
        self.loss = self.score - second
        self.rows, self.codes = self.e_word[path], self.e_code[path]

    def _edges(self, char0: np.ndarray) -> None:
        word = np.repeat(np.arange(len(self.length)), self.length)
        at = np.arange(len(self.points))
        room = (char0 + self.length)[word] - at
        sums = _Sums(self.points)
        starts, widths, found = [], [], []
        for width in range(1, self.v.longest + 1):
            here = at[room >= width]
            if not len(here):
                break
            hit = self.v.find(sums.of(here, here + width))
            keep = np.flatnonzero(hit >= 0) if width > 1 else np.arange(len(here))
            starts.append(here[keep])
            widths.append(np.full(len(keep), width))
            found.append(hit[keep])
        start, width, found = (np.concatenate(x) if x else np.empty(0, np.int64) for x in (starts, widths, found))
        self.e_word = word[start]
        self.e_from = start + self.e_word  # one node more than characters in each word before
        self.e_to = self.e_from + width
        self.e_code = _codes(self.v, found, self.points[start])
        self.e_score = np.where(found >= 0, self.v.scores[found], self.v.unknown)

    def _solve(self, u: int, rest: np.ndarray) -> list[int]:
        """Fill ``forward`` and ``rest`` of one word; the edges of its best path."""
        order, lead = self.of_word
        edges = order[lead[u]:lead[u + 1]]
        begin, size = int(self.node0[u]), int(self.length[u])
        before, after, best = [0.0] + [-np.inf] * size, [-np.inf] * size + [0.0], [-1] * (size + 1)
        start, end, score = (c[edges].tolist() for c in (self.e_from - begin, self.e_to - begin, self.e_score))
        for i in np.argsort(self.e_to[edges], kind="stable").tolist():
            value = before[start[i]] + score[i]
            if value > before[end[i]]:
                before[end[i]], best[end[i]] = value, i
        for i in np.argsort(-self.e_from[edges], kind="stable").tolist():
            after[start[i]] = max(after[start[i]], after[end[i]] + score[i])
        self.forward[begin:begin + size + 1], rest[begin:begin + size + 1] = before, after
        path, node = [], size
        while node:
            path.append(int(edges[best[node]]))
            node = start[best[node]]
        return path[::-1]

    def lattices(self, words: np.ndarray) -> Iterator[tuple[Lattice, list[float]]]:
        order, lead = self.of_word
        for u in words.tolist():
            begin, own = self.node0[u], order[lead[u]:lead[u + 1]]
            into: Lattice = [[] for _ in range(self.length[u] + 1)]
            for a, z, score, code in zip((self.e_from[own] - begin).tolist(), (self.e_to[own] - begin).tolist(),
                                         self.e_score[own].tolist(), self.e_code[own].tolist()):
                into[z].append((a, score, code))
            yield into, self.forward[begin:begin + len(into)].tolist()


class Segments:
    """The words of some texts, each distinct one with its lattice, best path and second-best loss."""

    def __init__(self, vocabulary: Vocabulary, texts: Sequence[str]):
        self.v = vocabulary
        marked = "".join(" " + t if t else "" for t in texts)
        points = np.frombuffer(marked.encode("utf-32-le"), np.uint32).astype(np.uint64)
        literal, space = points == MARK, points == 0x20
        points[literal], points[space] = LITERAL_MARK, MARK
        sizes = np.fromiter((len(t) + 1 if t else 0 for t in texts), np.int64, len(texts))
        first = np.cumsum(sizes) - sizes
        begin = space.copy()
        if len(points):
            begin[1:] &= ~space[:-1]
            begin[first[sizes > 0]] = True
        starts = np.flatnonzero(begin)
        ends = np.append(starts[1:], len(points))
        h = _Sums(points).of(starts, ends)
        order = np.argsort(h)
        new = np.diff(h[order], prepend=~h[order[:1]]) != 0
        one, which = order[new], np.empty_like(order)
        which[order] = np.cumsum(new) - 1
        length = ends[one] - starts[one]
        by_length = np.argsort(-length, kind="stable")
        number = np.empty_like(by_length)
        number[by_length] = np.arange(len(by_length))
        # Words of text d are which[bounds[d]:bounds[d + 1]].
        self.which = number[which]
        self.bounds = np.searchsorted(starts, np.append(first, len(points)))
        one, length = one[by_length], length[by_length]
        self.n_long = n = int((length > _LONG).sum())
        self.long = _LongWords(self.v, points, starts[one[:n]], length[:n])
        self.short = _ShortWords(self.v, points, starts[one[n:]], length[n:])
        self.score, self.loss = (np.concatenate([getattr(x, c) for x in (self.long, self.short)]) for c in ("score", "loss"))
        self._spell(np.concatenate([self.long.rows, self.short.rows + n]), np.concatenate([self.long.codes, self.short.codes]))
        # By n: the places of each text in which its n best may differ, and the lattices of the words there.
        self.searched: dict[int, tuple[list[list[int]], dict[int, tuple[Lattice, list[float]]]]] = {}

    def _spell(self, rows: np.ndarray, codes: np.ndarray) -> None:
        """The ids of every word, from the codes along its best path."""
        codes = codes[np.argsort(rows, kind="stable")]
        size = np.ones(len(codes), np.int64)
        unknown = np.flatnonzero(codes < 0)
        characters, which = np.unique(codes[unknown], return_inverse=True)
        spelled = [_ids_of(self.v, c) for c in characters.tolist()]
        size[unknown] = np.array([len(s) for s in spelled], np.int64)[which]
        place = np.cumsum(size) - size
        self.flat = np.repeat(codes, size).astype(np.int32)
        for k in range(4):
            has = np.flatnonzero(size[unknown] > k)
            self.flat[place[unknown[has]] + k] = np.array([s[k] if k < len(s) else 0 for s in spelled], np.int32)[which[has]]
        self.count = np.bincount(np.sort(rows, kind="stable"), size, len(self.score)).astype(np.int64)
        self.id0 = np.cumsum(self.count) - self.count

    def ids(self) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, one after the other, and where each text begins (and the last ends)."""
        count = self.count[self.which]
        before = np.cumsum(count) - count
        flat = self.flat[np.repeat(self.id0[self.which] - before, count) + np.arange(count.sum())]
        return flat, np.append(before, count.sum())[self.bounds]

    def _search(self, n: int) -> tuple[list[list[int]], dict[int, tuple[Lattice, list[float]]]]:
        places, asked, losses = [], [np.empty(0, np.int64)], [np.empty(0)]
        for a, z in itertools.pairwise(self.bounds.tolist()):
            words = self.which[a:z]
            loss = self.loss[words]
            own = np.sort(np.argpartition(loss, n - 2)[:n - 1] if n - 1 < len(words) else np.arange(len(words)))
            own = own[np.isfinite(loss[own])] if n > 1 else own[:0]
            places.append(own.tolist())
            asked.append(words[own])
            # With n - 1 words to change, one at a time, nothing that loses more than the last of them is among the n best.
            losses.append(np.full(len(own), loss[own].max() if 0 < len(own) == n - 1 else np.inf))
        words, number = np.unique(np.concatenate(asked), return_inverse=True)
        most = np.zeros(len(words))
        np.maximum.at(most, number, np.concatenate(losses))
        long = np.searchsorted(words, self.n_long)
        lattices = itertools.chain(self.long.lattices(words[:long]), self.short.lattices(
            words[long:] - self.n_long, self.score[words[long:]] - most[long:]))
        return places, dict(zip(words.tolist(), lattices))

    def n_best(self, text: int, n: int) -> list[tuple[float, list[tuple[int, list[int]]]]]:
        """The ``n`` best segmentations of a text: score, and (place, ids) of each word not in its best form.

        Only words with the n - 1 least losses (best minus second-best score) can differ in
        them: a segmentation that changes another word is worse than all that change one
        of these. So the search runs over the chain of these words' lattices.
        """
        words = self.which[self.bounds[text]:self.bounds[text + 1]]
        total = float(self.score[words].sum())
        if n not in self.searched:
            self.searched[n] = self._search(n)
        places, lattices = self.searched[n][0][text], self.searched[n][1]
        chain = [int(words[p]) for p in places]
        if not chain:
            return [(total, [])] if len(words) else []
        inner = sum(float(self.score[u]) for u in chain)
        found = []
        for score, paths in a_star(*map(list, zip(*map(lattices.get, chain))), n):
            changed = []
            for place, u, path in zip(places, chain, paths):
                ids = [i for code in path for i in _ids_of(self.v, code)]
                if ids != self.flat[self.id0[u]:self.id0[u] + self.count[u]].tolist():
                    changed.append((place, ids))
            found.append((total - inner + score, changed))
        return found


def a_star(lattices: list, forward: list[list[float]], n: int) -> list[tuple[float, list[list[int]]]]:
    """The ``n`` best paths through a chain of lattices, best first: (score, codes by lattice).

    The search runs backward from the last node. The forward Viterbi score of a node is exactly
    the best that can still come before it, so partial paths leave the agenda in the
    order of the best whole path they belong to, and the first n whole ones are the n best.
    """
    before = list(itertools.accumulate((f[-1] for f in forward), initial=0.0))
    # Of equal bounds the latest goes on, so a plateau of equal paths is not searched in breadth.
    ticket = itertools.count(0, -1)
    last = len(lattices) - 1
    agenda = [(-before[-1], next(ticket), last, len(lattices[last]) - 1, 0.0, None)]
    found = []
    while agenda and len(found) < n:
        bound, _, k, node, behind, path = heapq.heappop(agenda)
        while node == 0 and k > 0:
            k -= 1
            node = len(lattices[k]) - 1
        if node == 0:
            edges: list[list[int]] = [[] for _ in lattices]
            while path:
                at, edge, path = path
                edges[at].append(edge)
            found.append((-bound, edges))
            continue
        for start, score, edge in lattices[k][node]:
            g = behind + score
            heapq.heappush(agenda, (-(before[k] + forward[k][start] + g), next(ticket), k, start, g, (k, edge, path)))
    return found
