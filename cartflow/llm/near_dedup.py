"""Near-duplicate classes: weighted MinHash over TF-IDF shingles, banded and verified.

1. Shingles of five words are weighted by occurrences times inverse document frequency, from the exact
   document count of every shingle (``shingle_idf``), which goes with the texts that are verified. They are
   sampled by improved consistent weighted sampling and banded, 16 bands of 4: a pair of
   similarity 0.8 shares no band once in 4,600 times.
2. Identical texts are one node, so copies never meet each other as pairs.
3. In each bucket (nodes that share a band) the least node is the hub, and every member
   is compared with the hub. Comparisons compute the weighted Jaccard similarity of the
   whole texts; 0.8 or more makes a link, and links make classes.
4. A bucket is settled when what is left of it lies in one class. The others are compared in
   full: cut into blocks by total weight, every block with every other, unless the weights of two blocks are too far
   apart for a link or both lie in one class. So every pair of every bucket is compared, known to be in one class, or
   cannot be a link. The cost grows with the square of a bucket that is not settled. ``until_settled=False`` leaves this
   step out. README has the figures.

Nulls and edge cases: a null text counts as empty; texts of one to four words have one
shingle (all of their words); texts without a word have none, so only identical ones share a
class; a class takes the least id of its documents; a row without an id joins the class of
texts identical to its own, and has a null class if there are none with an id; of repeated
rows one is kept; other columns play no part; a table without rows gives none.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cartflow.llm.common import blocks, fresh, id_and_text, small_batches, stored, text_or_empty
from cartflow.llm.components import merged
from cartflow.llm.shingle_idf import Idf, counts_of, idf_of, pack, packed_texts, weights, with_counts
from cartflow.llm.weighted_minhash import Sampler
from cartflow.llm.words import HASH_BITS, WordBlock
from cartflow.plans.ordered import running_totals

SIMILARITY = 0.8
# A block of a bucket: this many bytes of text (and at most one text more), short texts counted as ``BLOCK_TEXT``.
BLOCK_TEXTS_BYTES, BLOCK_TEXT = 1 << 21, 1 << 12
_DENSE_COLUMNS = 1 << 12


def _node() -> Column:
    """Identity of a text: 128 bits of its SHA-256."""
    return F.substring(F.unhex(F.sha2(text_or_empty(), 256)), 1, 16)


def _signatures(docs: DataFrame) -> tuple[DataFrame, int]:
    """doc_id, node, row, bands, total weight and packed shingle counts of each document; how many have a word."""
    def sign(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sampler = Sampler()
        for batch in batches:
            for i in range(batch.num_rows):
                ids, node, row, text = (batch.column(k)[i].values for k in range(4))
                texts = text.cast(pa.binary()).to_pylist()
                doc, h, times = WordBlock(texts).shingle_sets()
                counts = counts_of(h, batch.column(4)[i].as_py())
                weight = times * weights(counts, n)
                present, keys = sampler.bands(doc, h, weight, len(texts))
                total = np.bincount(doc, weight, minlength=len(texts))
                sizes = np.zeros(len(texts) + 1, np.int32)
                sizes[present + 1] = keys.shape[1]
                bands = pa.ListArray.from_arrays(pa.array(np.cumsum(sizes, dtype=np.int32)),
                                                 pa.array(keys.ravel().view(np.int64)))
                cuts = np.searchsorted(doc, np.arange(len(texts) + 1)).tolist()
                packed = pa.array([pack(counts[a:b]) for a, b in zip(cuts, cuts[1:])], pa.binary())
                yield pa.RecordBatch.from_arrays([ids, node, row, bands, pa.array(total, pa.float64()), packed],
                                                 names=["doc_id", "node", "row", "bands", "total", "counts"])

    # The number tells repeated rows apart; it is stored with the block.
    packed = packed_texts(id_and_text(docs).select("doc_id", _node().alias("node"),
                                                   F.monotonically_increasing_id().alias("row"), "text"))
    n = packed.agg(F.sum("worded")).first()[0] or 0
    signed = with_counts(packed).select("doc_id", "node", "row", "text", "answers").mapInArrow(
        sign, "doc_id long, node binary, row long, bands array<long>, total double, counts binary")
    return stored(signed, "signatures"), n


def weighted_jaccard(left: list[bytes], right: list[bytes], idf: Idf) -> np.ndarray:
    """Similarity of each text with the one at the same place; 0 where neither has a word."""
    def weighted(texts):
        doc, h, times = WordBlock(texts).shingle_sets()
        w = times * idf.of(h)
        return (doc.astype(np.uint64) << np.uint64(HASH_BITS)) | h, w, np.bincount(doc, w, minlength=len(texts))

    a, wa, all_a = weighted(left)
    b, wb, all_b = weighted(right)
    if not len(a) or not len(b):
        return np.zeros(len(left))
    at = np.minimum(np.searchsorted(b, a), len(b) - 1)
    same = b[at] == a
    shared = np.bincount((a[same] >> np.uint64(HASH_BITS)).astype(np.int64),
                         np.minimum(wa[same], wb[at[same]]), minlength=len(left))
    return shared / np.maximum(all_a + all_b - shared, 1e-12)


def _compared(pairs: DataFrame, texts: DataFrame, n: int) -> DataFrame:
    """a, b, similarity of each pair of nodes."""
    def verify(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, left in blocks(batches, "text_a"):
            right = rows.column(3).cast(pa.binary()).to_pylist()
            idf = idf_of(left + right, rows.column(4).to_pylist() + rows.column(5).to_pylist(), n)
            yield pa.RecordBatch.from_arrays(
                [rows.column(0), rows.column(1), pa.array(weighted_jaccard(left, right, idf))],
                names=["a", "b", "similarity"])

    side = lambda x: texts.select(F.col("node").alias(x), F.col("text").alias(f"text_{x}"), F.col("counts").alias(f"counts_{x}"))
    both = pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "text_a", "text_b", "counts_a", "counts_b")
    return stored(both.mapInArrow(verify, "a binary, b binary, similarity double"), "compared")


def _texts_of(docs: DataFrame, nodes: DataFrame) -> DataFrame:
    """node, text, total, counts for each of ``nodes`` (node, id, total, counts), read from its document."""
    once = Window.partitionBy("id", "node").orderBy(F.lit(1))
    found = (docs.select(F.col("doc_id").cast("long").alias("id"), _node().alias("node"),
                         text_or_empty().alias("text"))
             .join(nodes, ["id", "node"]))
    return stored(found.withColumn("n", F.row_number().over(once)).where("n = 1").select("node", "text", "total", "counts"), "texts")


def _pairs(members: DataFrame) -> DataFrame:
    """Member-hub pairs of the buckets, each pair once, the smaller node first."""
    return members.where("node != hub").select(
        F.least("node", "hub").alias("a"), F.greatest("node", "hub").alias("b")).distinct()


def joined_roots(texts: list[bytes], roots: list[bytes], left: np.ndarray, right: np.ndarray,
                 idf: Idf) -> list[tuple[bytes, bytes]]:
    """Pairs of roots that links between texts at ``left`` and at ``right`` join, as few as give the same classes."""
    doc, h, times = WordBlock(texts).shingle_sets()
    # The second occurrence of a shingle is a column of its own, so shared columns add up to the lesser count.
    entry = np.repeat(np.arange(len(h)), times)
    nth = np.arange(len(entry)) - np.repeat(np.cumsum(times) - times, times)
    weight = idf.of(h)
    total = np.bincount(doc, times * weight, minlength=len(texts))
    _, shingle = np.unique(h, return_inverse=True)
    _, column, n = np.unique(shingle[entry] * (times.max(initial=0) + 1) + nth, return_inverse=True, return_counts=True)
    several = n[column] > 1
    row, of_row, column = doc[entry][several], weight[entry][several], column[several]
    _, column = np.unique(column, return_inverse=True)
    order = np.argsort(column, kind="stable")
    row, of_row, column = row[order], of_row[order], column[order]

    distinct, root = np.unique(np.array(roots, object), return_inverse=True)
    main = np.bincount(root).argmax()
    parent = list(range(len(distinct)))

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    out = []
    # Two texts of the most frequent class are never compared.
    for one, two in ((left[root[left] != main], right), (left[root[left] == main], right[root[right] != main])):
        shared = np.zeros((len(one), len(two)))
        if not shared.size:
            continue
        for start in range(0, column.max(initial=-1) + 1, _DENSE_COLUMNS):
            lo, hi = np.searchsorted(column, [start, start + _DENSE_COLUMNS])
            present = np.zeros((len(texts), min(_DENSE_COLUMNS, column[hi - 1] - start + 1)))
            present[row[lo:hi], column[lo:hi] - start] = of_row[lo:hi]
            shared += (present[one] > 0).astype(float) @ present[two].T
        similarity = shared / np.maximum(total[one][:, None] + total[two] - shared, 1e-12)
        a, b = np.nonzero((similarity >= SIMILARITY) & (root[one][:, None] != root[two]))
        for x, y in np.unique(np.stack([root[one][a], root[two][b]], 1), axis=0).tolist():
            x_root, y_root = find(x), find(y)
            if x_root != y_root:
                parent[x_root] = y_root
                out.append((distinct[x], distinct[y]))
    return out


def _rest(rows: DataFrame, texts: DataFrame, n: int) -> DataFrame:
    """a, b: pairs of roots joined by links within the buckets of ``rows`` (band, key, node, root)."""
    weighed = rows.select("band", "key", "node", "root").join(
        texts.select("node", "total", F.greatest(F.octet_length("text"), F.lit(BLOCK_TEXT)).alias("cost")), "node")
    # A bucket with many texts is sorted in as many slices as it needs.
    upto = running_totals(stored(weighed, "weighed"), ["total", "node"], {"upto": F.col("cost")}, ["band", "key"])
    block = F.floor((F.col("upto") - F.col("cost")) / BLOCK_TEXTS_BYTES)
    blocked = stored(upto.withColumn("block", block).drop("cost", "upto"), "blocks")
    spans = blocked.groupBy("band", "key", "block").agg(
        F.min("total").alias("least"), F.max("total").alias("most"), F.min("root").alias("low"), F.max("root").alias("high"))
    spans = stored(spans, "spans")
    one = spans.select("band", "key", F.col("block").alias("i"), F.col("most").alias("most_i"),
                       F.col("low").alias("low_i"), F.col("high").alias("high_i"))
    # Blocks are in the order of total weight; a pair cannot be more alike than the lesser total is of the greater.
    tiles = (one.join(spans.withColumnRenamed("block", "j"), ["band", "key"])
             .where((F.col("i") <= F.col("j")) & (F.col("most_i") >= F.col("least") * (SIMILARITY - 1e-9)))
             .where("least(low_i, low) != greatest(high_i, high)")
             .select("band", "key", "i", "j", F.explode(F.array_distinct(F.array("i", "j"))).alias("block")))

    def join(tile: pa.Table) -> pa.Table:
        block, i, j = (tile.column(c).to_numpy() for c in ("block", "i", "j"))
        some = tile.column("text").cast(pa.binary()).to_pylist()
        found = joined_roots(some, tile.column("root").to_pylist(), np.flatnonzero(block == i), np.flatnonzero(block == j),
                             idf_of(some, tile.column("counts").to_pylist(), n))
        return pa.table({"a": pa.array([a for a, _ in found], pa.binary()),
                         "b": pa.array([b for _, b in found], pa.binary())})

    both = (blocked.drop("total").join(tiles, ["band", "key", "block"]).join(texts.select("node", "text", "counts"), "node")
            .groupBy("band", "key", "i", "j").applyInArrow(join, "a binary, b binary"))
    return stored(both, "joined")


def _links(docs: DataFrame, nodes: DataFrame, n: int, until_settled: bool) -> DataFrame:
    """node, root for the nodes that share a bucket with another one."""
    keyed = nodes.where("best.id IS NOT NULL").select("node", F.col("best.id").alias("id"), "total",
                                                      F.posexplode("bands").alias("band", "key"))
    shared = stored(keyed.groupBy("band", "key").agg(F.count(F.lit(1)).alias("n"), F.min("node").alias("hub"))
                    .where("n > 1").drop("n"), "shared")
    members = stored(keyed.join(shared, ["band", "key"]), "members")
    linked = nodes.select("node", F.col("best.id").alias("id"), "total", "counts").join(members.select("node").distinct(), "node")
    texts = _texts_of(docs, linked)
    roots = stored(members.select("node").distinct().withColumn("root", F.col("node")), "roots")
    links = _compared(_pairs(members), texts, n).where(F.col("similarity") >= SIMILARITY)
    roots = merged(roots, links)
    if not until_settled:
        return roots
    rooted = members.where("node != hub").select("band", "key", "node").join(roots, "node")
    unsettled = (rooted.groupBy("band", "key").agg(F.min("root").alias("low"), F.max("root").alias("high"))
                 .where("low != high").select("band", "key"))
    return merged(roots, _rest(rooted.join(unsettled, ["band", "key"]), texts, n))


def _classes(docs: DataFrame, until_settled: bool = True) -> tuple[DataFrame, DataFrame]:
    """Stored signatures, and per node the best row of the node and of its class."""
    signed, n = _signatures(docs)
    order = F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("id"), F.col("row"))
    nodes = stored(signed.groupBy("node").agg(F.min(order).alias("best"), F.count(F.lit(1)).alias("copies"),
                                              F.first("bands").alias("bands"), F.first("total").alias("total"),
                                              F.first("counts").alias("counts")), "nodes")
    roots = _links(docs, nodes, n, until_settled)
    rooted = stored(nodes.select("node", "best", "copies").join(roots, "node", "left")
                    .withColumn("root", F.coalesce("root", "node")), "rooted")
    # Stored, so that both sides of the join come from a shuffle and a class of many texts is split.
    of_class = stored(rooted.groupBy("root").agg(F.min("best").alias("class_best"), F.sum("copies").alias("class_size")), "of_class")
    return signed, stored(rooted.join(of_class, "root").select("node", "best", "class_best", "class_size"), "classes")


def near_duplicates(docs: DataFrame, until_settled: bool = True) -> DataFrame:
    """One row per document: doc_id, class_id (least id of its class), class_size and kept."""
    with small_batches(docs.sparkSession):
        signed, classes = _classes(docs, until_settled)
    return signed.select("doc_id", "row", "node").join(classes, "node").select(
        "doc_id", F.col("class_best.id").alias("class_id"), "class_size",
        (F.col("row") == F.col("class_best.row")).alias("kept"))


def without_near_duplicates(docs: DataFrame, until_settled: bool = True) -> DataFrame:
    """The rows of ``docs``, all columns, one of each class (that with the least id)."""
    with small_batches(docs.sparkSession):
        _, classes = _classes(docs, until_settled)
    node, rank, best = fresh(docs, "node"), fresh(docs, "rank"), fresh(docs, "best")
    winners = classes.where("best.row = class_best.row").select(F.col("node").alias(node), F.col("best.id").alias(best))
    doc_id = F.col("doc_id").cast("long")
    once = Window.partitionBy(node).orderBy(F.lit(1))
    tagged = docs.withColumn(node, _node())
    return (tagged.join(winners, (tagged[node] == winners[node]) & doc_id.eqNullSafe(winners[best])).drop(winners[node])
            .withColumn(rank, F.row_number().over(once)).where(F.col(rank) == 1)
            .select(*[F.col(f"`{c}`") for c in docs.columns]))
