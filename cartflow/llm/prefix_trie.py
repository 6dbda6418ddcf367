"""The prefix trie of conversations, by fixed-length blocks of turns.

Conversations are cut into blocks of ``BLOCK`` turns and grouped by the chain of block digests first. Where all
conversations that share a chain go on with the same block, its turns have the same members and are one unit; only blocks
in which siblings diverge are refined, turn by turn. A unit stands for one node a turn.

Figures of subtrees need no walk over the trie. The smallest member of a node is called its owner; a
conversation owns the nodes of a last stretch of its path (perhaps none), and every node has one owner. So sums over
the nodes of a subtree are sums over the members of its top of what each of them owns, put right for the
owner of the top, who owns some of the nodes above it too.

A block digest is the SHA-256 of the turns' digests; chains add up five 32-bit hashes of (block number, block digest), so that they are
running sums, which a conversation of any length gets from ordered slices. Joins split heavy keys. Ids of the
conversations that end at a node are joined to texts by ranges of 1,024 ids, and a node's texts are hashed one after the
other, as SHA-256 asks for, without holding them together.

Nulls and edge cases: rows without a conv_id are left out; a null role or text is empty; null turns come first; rows of one
conversation with equal turns come in the order of their digests, so repeated rows are repeated turns. Very long
texts enter as digest and length only. An empty table has no nodes; other columns play no part.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartflow.llm.common import stored
from cartflow.plans.heavy import heavy_of_counts, split_join
from cartflow.plans.ordered import positions, running_totals

BLOCK = 4
FAMILY, HEADS = 100, 6
LANES = [f"lane{i}" for i in range(5)]
EMPTY_SHA256 = hashlib.sha256(b"").hexdigest()
_ID_BITS = 10


def digested_turns(conversations: DataFrame) -> DataFrame:
    """conv_id, place (1, 2, ...), digest of role and text, and the text's code points."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    rows = conversations.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").alias("turn"),
        F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256).alias("digest"),
        F.length(text).cast("long").alias("chars"))
    placed = positions(rows, [F.col("turn").asc_nulls_first(), F.col("digest")], "place", ["conv_id"])
    return placed.drop("turn")


def rebuilt_turns(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Every conversation with the head of its family's first one in place of its own, and all conv_ids with their lengths.

    The head is the first crc32(conv_id) % 6 turns of conversation ``conv_id - conv_id % 100``.
    """
    turns = stored(turns, "turns")
    own = stored(turns.groupBy("conv_id").agg(F.count(F.lit(1)).alias("own")), "own")
    head = F.crc32(F.col("conv_id").cast("string").cast("binary")) % HEADS
    sized = own.withColumns({"h": head, "base": F.col("conv_id") - F.col("conv_id") % FAMILY}).join(
        own.select(F.col("conv_id").alias("base"), F.col("own").alias("base_own")), "base", "left")
    lengths = stored(
        sized.withColumn("head", F.least("h", F.coalesce("base_own", F.lit(0))))
        .withColumn("length", F.col("head") + F.greatest(F.col("own") - F.col("h"), F.lit(0))), "lengths")
    heavy = heavy_of_counts(own, ["conv_id"], "own", turns.count())
    tails = (split_join(turns, lengths.select("conv_id", "h", "head", "length"), ["conv_id"], "inner", heavy)
             .where(F.col("place") > F.col("h"))
             .select("conv_id", (F.col("place") - F.col("h") + F.col("head")).alias("place"), "digest", "chars", "length"))
    # A place of a first conversation is asked for by its family only, so no key of this join is large.
    wanted = lengths.where("head > 0").select(
        F.col("conv_id").alias("to"), F.col("base").alias("conv_id"), "length", F.explode(F.sequence(F.lit(1).cast("long"), "head")).alias("place"))
    heads = (wanted.join(turns.where(F.col("place") < HEADS), ["conv_id", "place"])
             .select(F.col("to").alias("conv_id"), "place", "digest", "chars", "length"))
    return tails.unionByName(heads), lengths.select("conv_id", "length")


def _key(depth: Column, lanes: list[Column]) -> Column:
    return F.concat_ws(".", depth.cast("string"), *[v.cast("string") for v in lanes])


ROOT = ".".join("0" * (1 + len(LANES)))


def _hashes(block: Column, digests: Column) -> list[Column]:
    code = F.sha2(F.array_join(digests, ""), 256)
    return [F.shiftrightunsigned(F.xxhash64(F.lit(i), block, code), 32) for i in range(len(LANES))]


def chained_blocks(rebuilt: DataFrame, block: int = BLOCK) -> DataFrame:
    """One row for each conversation and block: its turns in order, and the chain sums before and through it."""
    cut = rebuilt.groupBy("conv_id", F.floor((F.col("place") - 1) / block).alias("block")).agg(
        F.array_sort(F.collect_list(F.struct("place", "digest", "chars"))).alias("turns"), F.max("length").alias("length"))
    hashed = cut.select("*", F.aggregate("turns.chars", F.lit(0).cast("long"), lambda a, b: a + b).alias("block_chars"),
                        *[h.alias(f"own_{n}") for h, n in zip(_hashes(F.col("block"), F.col("turns.digest")), LANES)])
    summed = running_totals(hashed, ["block"], {**{n: F.col(f"own_{n}") for n in LANES}, "chars_through": F.col("block_chars")},
                            ["conv_id"])
    before = [F.col(n) - F.col(f"own_{n}") for n in LANES]
    start = F.col("block") * block
    return summed.select(
        "conv_id", "block", "turns", "length", "block_chars", (F.col("chars_through") - F.col("block_chars")).alias("chars_before"),
        _key(start, before).alias("before"), _key(start + F.size("turns"), [F.col(n) for n in LANES]).alias("through"),
        F.array(*before).alias("lanes"))


def units(blocks: DataFrame) -> DataFrame:
    """Stretches of paths with the same members: whole blocks, or single turns where siblings diverge."""
    code = [F.xxhash64("through"), F.xxhash64(F.lit(1), "through")]
    chains = stored(blocks.groupBy("before").agg(
        F.count(F.lit(1)).alias("members"), *[f(c).alias(f"{f.__name__}{i}") for i, c in enumerate(code) for f in (F.min, F.max)]), "chains")
    chains = chains.select("before", "members", ((F.col("min0") != F.col("max0")) | (F.col("min1") != F.col("max1"))).alias("diverge"))
    marked = split_join(blocks, chains.select("before", "diverge"), ["before"], "inner",
                        heavy_of_counts(chains, ["before"], "members", blocks.count()))
    start = F.element_at("turns", 1)["place"] - 1

    def key_after(n: Column) -> Column:
        """The key of the node after the first ``n`` turns of the block."""
        hashes = _hashes(F.col("block"), F.slice("turns.digest", F.lit(1), n))
        return F.when(n == 0, F.col("before")).otherwise(_key(start + n, [F.col("lanes")[i] + h for i, h in enumerate(hashes)]))

    def single(n: Column) -> Column:
        before = F.aggregate(F.slice("turns.chars", F.lit(1), n - 1), F.lit(0).cast("long"), lambda a, b: a + b)
        return F.struct(key_after(n).alias("key"), key_after(n - 1).alias("before"), (start + n).alias("depth"),
                        F.slice("turns.chars", n, F.lit(1)).alias("chars"), (F.col("chars_before") + before).alias("chars_before"))

    whole = F.struct(F.col("through").alias("key"), F.col("before"), (start + F.size("turns")).alias("depth"),
                     F.col("turns.chars").alias("chars"), F.col("chars_before"))
    parts = F.when(F.col("diverge"), F.transform(F.sequence(F.lit(1), F.size("turns")), single)).otherwise(F.array(whole))
    return marked.select("conv_id", "length", F.explode(parts).alias("unit")).select(
        "conv_id", "unit.*", (F.col("unit.depth") == F.col("length")).alias("last"),
        F.aggregate("unit.chars", F.lit(0).cast("long"), lambda a, b: a + b).alias("unit_chars"))


def ends_digest(ends: DataFrame) -> DataFrame:
    """``key`` and the SHA-256 of its conv_ids, in ascending order and joined by commas.

    Ids of a range of 1,024 are joined to one text, so a key that ends a third of all conversations is spread over
    many ranges; its texts, in order, then pass through one hash.
    """
    texts = ends.groupBy("key", F.shiftright("conv_id", _ID_BITS).alias("part")).agg(
        F.array_join(F.transform(F.array_sort(F.collect_list("conv_id")), lambda i: i.cast("string")), ",").alias("ids"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, digest = None, None
        for batch in batches:
            done = []
            for next_key, ids in zip(batch["key"].to_pylist(), batch["ids"].to_pylist()):
                if next_key == key:
                    digest.update(b",")
                else:
                    if key is not None:
                        done.append((key, digest.hexdigest()))
                    key, digest = next_key, hashlib.sha256()
                digest.update(ids.encode())
            yield _digests(done)
        if key is not None:
            yield _digests([(key, digest.hexdigest())])

    ordered = texts.repartition("key").sortWithinPartitions("key", "part").select("key", "ids")
    return ordered.mapInArrow(run, "key string, ends_sha256 string")


def _digests(rows: list[tuple[str, str]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([k for k, _ in rows], pa.string()), pa.array([d for _, d in rows], pa.string())],
                                      names=["key", "ends_sha256"])


def _owners(parts: DataFrame, total: int) -> DataFrame:
    """For each conversation the characters of its path, those of the nodes it owns, and whether it owns a childless node."""
    first = stored(parts.groupBy("key").agg(F.min("conv_id").alias("owner"), F.count(F.lit(1)).alias("n"),
                                            F.sum(F.col("last").cast("long")).alias("ends")), "first-members")
    owned = split_join(parts.select("conv_id", "key", "last", "unit_chars"), first, ["key"], "inner", heavy_of_counts(first, ["key"], "n", total))
    mine = F.col("owner") == F.col("conv_id")
    return stored(owned.groupBy("conv_id").agg(
        F.count(F.lit(1)).alias("parts"), F.sum("unit_chars").alias("total"),
        F.sum(F.when(mine, F.col("unit_chars")).otherwise(0)).alias("owned"),
        F.max((mine & F.col("last") & (F.col("ends") == F.col("n"))).cast("long")).alias("leaf")), "owners")


def trie(rebuilt: DataFrame, lengths: DataFrame, block: int = BLOCK) -> DataFrame:
    """Every node: conv_id (smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    ``rebuilt`` has conv_id, place (1, 2, ... without gaps), digest, chars and length; ``lengths`` all conversations, turnless ones too.
    """
    parts = stored(units(stored(chained_blocks(rebuilt, block), "blocks")), "units")
    total = parts.count()
    owners = _owners(parts, total)
    members = split_join(parts, owners, ["conv_id"], "inner", heavy_of_counts(owners, ["conv_id"], "parts", total))
    stretches = stored(members.groupBy("key").agg(
        F.min(F.struct("conv_id", "total", "owned", "before", "depth", "chars", "chars_before")).alias("top"),
        F.count(F.lit(1)).alias("n_convs"), F.sum("leaf").alias("n_leaves"),
        (F.sum("total") - F.sum("owned")).alias("spared")).select("key", "top.*", "n_convs", "n_leaves", "spared"), "stretches")
    children = stored(stretches.groupBy("before").agg(F.count(F.lit(1)).alias("children")), "children")
    ends = stored(ends_digest(parts.where("last").select("key", "conv_id").unionByName(
        lengths.where("length = 0").select(F.lit(ROOT).alias("key"), "conv_id"))), "ends")
    parents = stretches.select(F.col("key").alias("before"), F.col("conv_id").alias("parent")).unionByName(
        lengths.agg(F.min("conv_id").alias("parent")).select(F.lit(ROOT).alias("before"), "parent"))
    return _inner_nodes(stretches, children, parents, ends).unionByName(_root(lengths, owners, children, ends))


def _inner_nodes(stretches: DataFrame, children: DataFrame, parents: DataFrame, ends: DataFrame) -> DataFrame:
    rows = split_join(stretches, parents, ["before"], "left", heavy_of_counts(children, ["before"], "children", stretches.count()))
    rows = (rows.join(children.withColumnRenamed("before", "key"), "key", "left").join(ends, "key", "left"))
    turn, size = F.col("turn"), F.size("chars")
    above = F.col("chars_before") + F.aggregate(F.slice("chars", F.lit(1), turn - 1), F.lit(0).cast("long"), lambda a, b: a + b)
    return rows.select("*", F.explode(F.sequence(F.lit(1), size)).alias("turn")).select(
        "conv_id", (F.col("depth") - size + turn).cast("long").alias("depth"),
        F.when(turn > 1, F.col("conv_id")).otherwise(F.col("parent")).alias("parent_conv_id"), "n_convs",
        F.when(turn < size, F.lit(1)).otherwise(F.coalesce("children", F.lit(0))).cast("long").alias("n_children"), "n_leaves",
        (F.col("spared") + F.col("owned") - F.col("total") - (F.col("n_convs") - 1) * above).alias("saved_tokens"),
        F.when(turn < size, F.lit(EMPTY_SHA256)).otherwise(F.coalesce("ends_sha256", F.lit(EMPTY_SHA256))).alias("ends_sha256"))


def _root(lengths: DataFrame, owners: DataFrame, children: DataFrame, ends: DataFrame) -> DataFrame:
    """The textless root; one row of totals each, so the joins are of single rows."""
    return (lengths.agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"))
            .where("n_convs > 0")
            .join(owners.agg(F.coalesce(F.sum("leaf"), F.lit(0)).alias("leaves"),
                             F.coalesce(F.sum("total") - F.sum("owned"), F.lit(0)).alias("saved_tokens")))
            .join(children.where(F.col("before") == ROOT).agg(F.coalesce(F.sum("children"), F.lit(0)).alias("n_children")))
            .join(ends.where(F.col("key") == ROOT).agg(F.coalesce(F.max("ends_sha256"), F.lit(EMPTY_SHA256)).alias("ends_sha256")))
            .select("conv_id", F.lit(0).cast("long").alias("depth"), F.lit(None).cast("long").alias("parent_conv_id"), "n_convs",
                    "n_children", F.greatest("leaves", F.lit(1)).cast("long").alias("n_leaves"), "saved_tokens", "ends_sha256"))
