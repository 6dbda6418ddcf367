"""Personal data: patterns, and sanitisation of terms that give protected entities away.

An entity is one value that the patterns find (an e-mail address, an IP address, a card or phone
number). A term is a run of letters in a document that has it. Over the whole corpus,
documents are counted with the entity, with the term, and with both;
the pointwise mutual information log(n(e,t) N / (n(e) n(t))) as a share of the entity's
information log(N / n(e)) is what the term discloses of it: 1 if the term occurs nowhere else.

A few common documents may be chance, so what counts is a lower confidence limit of that share: the share of the term's
documents that have the entity, n(e,t) / n(t), is lowered to the least value under which so many common documents would
be seen with a probability of 1 / N^0.75 (the Chernoff bound, with its part for the other documents bounded from below).
It is .25 at most for a single common document and passes .5 with two, if the term occurs nowhere else (from 16 documents on). A term whose
limit reaches ``GENERALISE`` is generalised, or removed if its estimate reaches ``REMOVE``, wherever it stands in the
documents of that entity.

Entities that occur in just the same documents disclose and are disclosed alike, and so do terms, so both are grouped by a
digest of their documents before they meet: long lists of addresses and words do not multiply.

Nulls and edge cases: a null text counts as empty and has no spans; repeated rows are
documents of their own; a null id is carried along; other columns play no part; with one
document, or an entity in all of them, nothing is disclosed and only pattern spans are left; equal limits count as
reached; very long texts are searched whole; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartflow.llm.common import blocks, id_and_text, stored
from cartflow.llm.words import HASH_BITS, HASH_MASK, NO_LETTER, WordBlock
from cartflow.plans.bitmap import may_match

KINDS = ("email", "ip", "card", "phone")
TERM_KINDS = ("generalised", "removed")
LEAST_TERM = 3
GENERALISE, REMOVE = 0.5, 0.9
# 1 / N^DOUBT is the error that the confidence limit allows.
DOUBT = 0.75
_CHUNK_WORDS = 1 << 21

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_DIGIT = re.compile(r"[0-9]")
# No match starts inside a run of digits that did not match from its first one.
_IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_NO_DIGIT = re.compile(r"[^0-9]+")
_TERM = re.compile(r"[A-Za-z\x80-\U0010ffff]+")


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Every match has one @, so the search goes from @ to @ and looks back along the local part."""
    done = 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        match = _DOMAIN.match(text, at + 1) if start < at else None
        if match:
            done = match.end()
            yield start, done
        at = text.find("@", match.end() if match else at + 1)


def _luhn(digits: str) -> bool:
    total = 0
    for place, digit in enumerate(reversed(digits)):
        value = int(digit) * (2 if place % 2 else 1)
        total += value - 9 if value > 9 else value
    return total % 10 == 0


def _octet(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) <= 3 and int(part or 0) <= 255


def find_base(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) of the pattern spans, by kind as listed, then start; characters, end exclusive."""
    spans = [("email", a, b) for a, b in _emails(text)] if "@" in text else []
    if _DIGIT.search(text):
        spans += [("ip", *m.span()) for m in _IP.finditer(text) if all(map(_octet, m[0].split(".")))]
        for m in _CARD.finditer(text):
            digits = _NO_DIGIT.sub("", m[0])
            if 16 <= len(digits) <= 19 and _luhn(digits):
                spans.append(("card", *m.span()))
        if "+" in text:
            spans += [("phone", *m.span()) for m in _PHONE.finditer(text) if 8 <= len(_NO_DIGIT.sub("", m[0])) <= 15]
    return spans


def written(spans: Iterable[tuple[str, int, int]]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for kind, start, end in spans)


def _terms(text: str, spans: list[tuple[str, int, int]]) -> list[tuple[int, int]]:
    """(start, end) of the terms that lie outside all spans."""
    taken = sorted((a, b) for _, a, b in spans)
    out, i, done = [], 0, 0
    for m in _TERM.finditer(text):
        s, e = m.span()
        while i < len(taken) and taken[i][0] < e:
            done = max(done, taken[i][1])
            i += 1
        if e - s >= LEAST_TERM and s >= done:
            out.append((s, e))
    return out


_FOUND = ("doc_id long, row long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, base string, text_sha256 string, "
          "entities array<long>, words array<struct<term: long, start: int, end: int>>")


def _find(docs: DataFrame) -> DataFrame:
    """Pattern spans of every document, hashes of its entities, and the terms of documents that have any."""
    term_type = pa.list_(pa.struct([("term", pa.int64()), ("start", pa.int32()), ("end", pa.int32())]))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, texts in blocks(batches):
            spans = [find_base(t) for t in map(bytes.decode, texts)]
            held, terms, words = [], [], []
            for raw, found in zip(texts, spans):
                text = raw.decode() if found else ""
                entities = [int.from_bytes(hashlib.blake2b(f"{k}:{text[a:b].lower()}".encode(), digest_size=8).digest(),
                                           "big", signed=True) for k, a, b in found]
                own = _terms(text, found) if found else []
                words += [text[s:e].encode() for s, e in own]
                held.append(sorted(set(entities)))
                terms.append(own)
            hashes = iter((WordBlock(words, NO_LETTER).hashes() & HASH_MASK).tolist() if words else [])
            base = [written(s) for s in spans]
            counts = [[sum(1 for x in s if x[0] == k) for s in spans] for k in KINDS]
            yield pa.RecordBatch.from_arrays([
                rows.column(0), rows.column(2), *[pa.array(c, pa.int64()) for c in counts],
                pa.array([hashlib.sha256(b.encode()).hexdigest() for b in base]), pa.array(base),
                pa.array([hashlib.sha256(raw).hexdigest() for raw in texts]),
                pa.array(held, pa.list_(pa.int64())),
                pa.array([[{"term": next(hashes), "start": s, "end": e} for s, e in own] for own in terms], term_type)],
                names=[f.split()[0] for f in _FOUND.split(", ")[:10]] + ["words"])

    numbered = id_and_text(docs).withColumn("row", F.monotonically_increasing_id())
    return stored(numbered.mapInArrow(run, _FOUND), "personal")


def _term_documents(docs: DataFrame) -> DataFrame:
    """term (hash), n: in how many documents of the whole table each run of letters occurs."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def flush():
            h, n = np.unique(np.concatenate(held), return_counts=True)
            return pa.RecordBatch.from_arrays([pa.array(h.astype(np.int64)), pa.array(n)], names=["term", "n"])

        for _, texts in blocks(batches):
            block = WordBlock(texts, NO_LETTER)
            key = np.unique((block.doc.astype(np.uint64) << np.uint64(HASH_BITS)) | (block.hashes() & HASH_MASK))
            held.append(key & HASH_MASK)
            size += len(held[-1])
            if size >= _CHUNK_WORDS:
                yield flush()
                held, size = [], 0
        if size:
            yield flush()

    counted = id_and_text(docs).select("text").mapInArrow(run, "term long, n long")
    return counted.groupBy("term").agg(F.sum("n").alias("n_term"))


def _by_documents(held: DataFrame, name: str) -> DataFrame:
    """``name`` with its number of rows, copies counted, and ``{name}_class``, equal where the rows are the same ones."""
    return held.groupBy(name).agg(F.sum("copies").alias(f"n_{name}"), _documents_digest().alias(f"{name}_class"))


def _documents_digest() -> Column:
    return F.xxhash64(*[F.sum(F.shiftrightunsigned(F.xxhash64(F.lit(i), "row"), 32)) for i in range(2)])


def disclosing(found: DataFrame, docs: DataFrame) -> DataFrame:
    """text_key (a hash of text_sha256), term, and the greatest estimate of those disclosures of the text's entities whose limit reaches ``GENERALISE``.

    Copies of a text hold the same entities and terms: one row stands for all of them, with their number.
    """
    n_docs = found.agg(F.count(F.lit(1)).alias("n")).first()["n"]
    texts = stored(found.where(F.size("entities") > 0).groupBy("text_sha256").agg(
        F.min("row").alias("row"), F.count(F.lit(1)).alias("copies")), "texts")
    held = (found.select("row", F.explode("entities").alias("entity")).join(texts.select("row", "copies"), "row"))
    # One common document never suffices, and an entity in all documents holds no information.
    entities = stored(_by_documents(held, "entity").where((F.col("n_entity") > 1) & (F.col("n_entity") < n_docs)), "entities")
    holders = stored(held.join(entities, "entity").select("row", "copies", "entity_class", "n_entity").distinct(), "holders")
    # Words of a few other texts get through as well: they may part classes, but meet no entity.
    words = may_match(found.select("row", "words"), "row", holders).select("row", F.explode(F.array_distinct("words.term")).alias("word"))
    classes = words.groupBy("word").agg(_documents_digest().alias("word_class"))
    # A term of n documents tells at most log(N / n) of an entity; more frequent ones cannot reach the limit for any.
    most = holders.agg(F.max("n_entity").alias("most")).first()["most"] or 1
    counts = _term_documents(docs).where((F.col("n_term") > 1) & (F.col("n_term") * F.col("n_term") <= float(n_docs) * most))
    terms = stored(classes.join(counts.withColumnRenamed("term", "word"), "word"), "terms")
    tagged = stored(words.join(terms, "word").select("row", "word", "word_class", "n_term"), "tagged")
    spoken = tagged.select("row", "word_class", "n_term").distinct()
    pairs = holders.join(spoken, "row").groupBy("entity_class", "word_class", "n_entity", "n_term").agg(F.sum("copies").alias("n_pair"))
    k, n, all_docs = F.col("n_pair"), F.col("n_term"), F.lit(float(n_docs))
    information = F.log(all_docs / F.col("n_entity"))
    mutual = F.log(k * all_docs / (F.col("n_entity") * n.cast("double")))
    others = F.when(n > k, (n - k) * F.log(n / (n - k))).otherwise(0.0)
    doubt = (DOUBT * F.log(all_docs) + others) / k
    told = stored(pairs.where((k > 1) & ((mutual - doubt) / information >= GENERALISE))
                  .select("entity_class", "word_class", "n_term", (mutual / information).alias("disclosure")), "told")
    rows = (holders.join(told, "entity_class").groupBy("row", "word_class", "n_term")
            .agg(F.max("disclosure").alias("disclosure")))
    return (tagged.join(rows, ["row", "word_class", "n_term"]).join(texts, "row")
            .select(F.xxhash64("text_sha256").alias("text_key"), F.col("word").alias("term"), "disclosure"))


def find(docs: DataFrame) -> DataFrame:
    """doc_id, row, the counts by kind, base_sha256, base, and terms: array of (kind, start, end) the method adds."""
    found = _find(docs)
    told = stored(disclosing(found, docs), "disclosing")
    spoken = found.select("row", F.xxhash64("text_sha256").alias("text_key"), "words")
    occurrences = may_match(spoken, "text_key", told).select("row", "text_key", F.explode("words").alias("x")).select(
        "row", "text_key", "x.term", "x.start", "x.end")
    kind = F.when(F.col("disclosure") >= REMOVE, F.lit(1)).otherwise(0)
    terms = (occurrences.join(told, ["text_key", "term"]).groupBy("row")
             .agg(F.array_sort(F.collect_list(F.struct(kind.alias("kind"), "start", "end"))).alias("terms")))
    return found.drop("entities", "words").join(terms, "row", "left")


def all_spans() -> Column:
    """Pattern spans and then the method's, as kind:start:end joined by commas."""
    added = F.transform(F.coalesce(F.col("terms"), F.array().cast("array<struct<kind:int,start:int,end:int>>")),
                        lambda t: F.concat(F.when(t["kind"] == 1, TERM_KINDS[1]).otherwise(TERM_KINDS[0]), F.lit(":"),
                                           t["start"].cast("string"), F.lit(":"), t["end"].cast("string")))
    return F.concat_ws(",", F.when(F.col("base") != "", F.col("base")), added)


def sanitise(docs: DataFrame) -> DataFrame:
    """doc_id and the text with pattern spans and generalised terms replaced by their kind, removed terms cut out.

    Documents are found again by id and a digest of the whole text, so this join moves the texts. Rows of equal id
    and text have equal spans.
    """
    spans = find(docs).select(F.col("doc_id").alias("id"), "text_sha256", all_spans().alias("spans"))
    spans = spans.groupBy("id", "text_sha256").agg(F.max("spans").alias("spans"))

    @F.pandas_udf("string")
    def applied(texts, spans):
        return texts.combine(spans, redact)

    rows = id_and_text(docs).withColumn("digest", F.sha2("text", 256))
    match = rows["doc_id"].eqNullSafe(spans["id"]) & (rows["digest"] == spans["text_sha256"])
    return rows.join(spans, match).select("doc_id", applied("text", "spans").alias("text"))


def redact(text: str, spans: str) -> str:
    """``text`` with each span replaced by its kind in brackets; removed terms leave nothing."""
    listed = sorted((int(a), -int(b), k) for k, a, b in (s.split(":") for s in spans.split(",") if s))
    out, done = [], 0
    for start, end, kind in listed:
        if start < done:
            continue
        out += [text[done:start], "" if kind == "removed" else f"[{kind}]"]
        done = -end
    return "".join(out) + text[done:]
