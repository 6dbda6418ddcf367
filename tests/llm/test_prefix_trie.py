"""The trie against a plain dictionary of prefixes."""

import hashlib
import random
import zlib

import pytest

from cartflow.llm import prefix_trie
from cartflow.llm.queries import QUERIES

SCHEMA = "conv_id long, turn long, role string, text string, place long, key string, depth int, length string"


def _rebuilt(rows):
    turns = {}
    for conv_id, turn, role, text in rows:
        if conv_id is not None:
            role, text = role or "", text or ""
            digest = hashlib.sha256(f"{len(role)}:{role}{text}".encode()).hexdigest()
            turns.setdefault(conv_id, []).append((turn is not None, turn or 0, digest, (role, text)))
    own = {c: [t[-1] for t in sorted(ts)] for c, ts in turns.items()}
    found = {}
    for c, ts in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        base = c - (c % 100 if c >= 0 else -(-c % 100))
        found[c] = own.get(base, [])[:h] + ts[h:]
    return found


def plain_trie(rows):
    members = {}
    for c, turns in _rebuilt(rows).items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append((c, d == len(turns)))
    children = {}
    for node in members:
        if node:
            children.setdefault(node[:-1], []).append(node)

    figures = {}
    for node in sorted(members, key=len, reverse=True):
        below = [figures[c] for c in children.get(node, [])]
        leaves = sum(b[0] for b in below) or 1
        saved = sum(b[1] for b in below) + (len(members[node]) - 1) * (len(node[-1][1]) if node else 0)
        figures[node] = leaves, saved
    result = set()
    for node, who in members.items():
        ends = ",".join(str(c) for c in sorted(c for c, last in who if last))
        parent = min(members[node[:-1]])[0] if node else None
        result.add((min(who)[0], len(node), parent, len(who), len(children.get(node, [])), *figures[node],
                    hashlib.sha256(ends.encode()).hexdigest()))
    return result, len(members)


COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def _same(found, rows):
    expected, n = plain_trie(rows)
    got = [tuple(r[c] for c in COLUMNS) for r in found.collect()]
    assert len(got) == n and set(got) == expected


def _trie(spark, rows, block=prefix_trie.BLOCK):
    table = spark.createDataFrame([(*r, 9, "k", 1, "l") for r in rows], SCHEMA)
    return prefix_trie.trie(*prefix_trie.rebuilt_turns(prefix_trie.digested_turns(table)), block=block)


def test_query_equals_a_plain_trie(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    _same(QUERIES["op13_prefix_trie"](spark, sf_dir), rows)


@pytest.mark.parametrize("seed,block", [(1, 1), (2, 2), (3, 4), (4, 3)])
def test_random_tries(spark, seed, block):
    """Few different turns, so that prefixes are shared to all depths; family heads missing, short or whole."""
    rng = random.Random(seed)
    rows = []
    for c in rng.sample(range(-150, 460), 220):
        turns = rng.randint(1, 11)
        same = rng.random() < 0.5
        rows += [(c, t, "u" if t % 2 else None, "same" * t if same else rng.choice(["a", "bb", "", None])) for t in range(turns)]
    _same(_trie(spark, rows, block), rows)


def test_awkward_rows(spark):
    rows = [(0, 1, "u", "one"), (0, None, None, None), (0, 1, "u", "one"), (0, 2, "", "ünï"), (None, 0, "u", "x"), (7, 0, "u", "a"),
            (205, 0, "u", "short"), (1, 5, "u", "x" * 100_000), (2, 5, "u", "x" * 100_000), (-3, 1, "u", "neg"), (1 << 60, 1, "u", "far")]
    _same(_trie(spark, rows), rows)


def test_no_rows_and_only_turnless(spark):
    assert _trie(spark, []).count() == 0
    lone = [c for c in range(1, 100) if zlib.crc32(str(c).encode()) % 6 > 1][:3]
    rows = [(c, 0, "u", "gone") for c in lone]
    assert all(not t for t in _rebuilt(rows).values())
    _same(_trie(spark, rows), rows)


def test_long_and_hot_conversations(spark):
    """One conversation holds half of all turns, and one content half of all conversations; ids span many ranges."""
    rows = [(900, t, "u", f"t{t}") for t in range(1500)]
    rows += [(c * 5000, t, "u", "hello" if t == 0 else "there") for c in range(1, 400) for t in range(3)]
    _same(_trie(spark, rows), rows)
