"""The vocabulary's hashes and the order of lattice edges."""

import numpy as np
import pytest

from cartflow.llm import piece_codec, pieces
from cartflow.llm.pieces import MARK, Segments, Vocabulary, _point_hashes, _Sums


@pytest.fixture(scope="module")
def vocabulary():
    return Vocabulary(piece_codec.model_bytes())


def test_pieces_are_hashed_by_length_like_substrings(vocabulary):
    for i in vocabulary.ids[::997].tolist():
        points = np.array([MARK if c == " " else ord(c) for c in vocabulary.bytes_of[i].decode()], np.uint64)
        one = _point_hashes(points[None])
        assert vocabulary.ids[vocabulary.find(one)].tolist() == [i]
        whole = np.concatenate([[7], points, [9]]).astype(np.uint64)
        assert _Sums(whole).of(np.array([1]), np.array([1 + len(points)])).tolist() == one.tolist()


def test_blocks_do_not_change_what_a_text_gives(vocabulary):
    texts = ["the cat sat on the mat", "", "a" * 100, "日本☃ x▁y", "  two  spaces ", "word" * 40 + " end"]
    together = Segments(vocabulary, texts)
    flat, bounds = together.ids()
    for i, text in enumerate(texts):
        alone = Segments(vocabulary, [text])
        assert alone.ids()[0].tolist() == flat[bounds[i]:bounds[i + 1]].tolist()
        assert [s for s, _ in alone.n_best(0, 4)] == [s for s, _ in together.n_best(i, 4)]


def test_words_by_position_and_by_edges_give_the_same(vocabulary, monkeypatch):
    texts = ["the cat sat on the mat", "a" * 47 + " " + "ab" * 24 + " " + "b" * 49, "日本☃ x▁y", "  two  spaces ", "▁" * 60 + " international"]
    found = []
    for long in (48, 0, 5):
        monkeypatch.setattr(pieces, "_LONG", long)
        words = Segments(vocabulary, texts)
        assert words.n_long == {48: 3, 0: len(words.score), 5: words.n_long}[long]
        found.append(([x.tolist() for x in words.ids()], [words.n_best(i, n) for i in range(len(texts)) for n in (1, 2, 4, 9)]))
    assert found[0] == found[1] == found[2]


def test_the_search_gets_only_edges_that_the_n_best_may_take(vocabulary):
    words = Segments(vocabulary, ["several ordinary words of an international organisation"])
    edges = {n: sum(len(into) for lattice, _ in words._search(n)[1].values() for into in lattice) for n in (2, 99)}
    assert edges[2] < edges[99] / 7
    assert words.n_best(0, 2) == words.n_best(0, 99)[:2]


def test_a_worker_reads_the_vocabulary_once():
    model = piece_codec.model_bytes()
    assert Vocabulary.of(model) is Vocabulary.of(bytes(bytearray(model)))
