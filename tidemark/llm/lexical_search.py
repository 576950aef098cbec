"""Ranked lexical search: sparse tables of maxima over posting lists, intervals of documents best first.

Every document is reduced to its terms that may occur in a query, told by a gate of ``GATE_SLOTS`` hash slots; this narrow
table is written once, and gives the counts of the corpus. Its documents are dealt into shards of about
``SHARD_DOCS``, the queries into blocks of at most ``BLOCK_ITEMS``, and each pair of a shard and a block is searched by a task of its own,
which gets postings of the terms of the block only.

In a shard, documents are ordered by length, and every term has a posting list of (document, impact) and a sparse table: the
largest impact in any stretch of the list is the larger of two entries. For a query, the maxima of its terms in an
interval of documents, each times its weight, add up to a bound of every score in it. The search starts
from the whole shard. It takes intervals by their bounds, the best first, many at a time. Of each it scores the
document that has the largest contribution of a single term and goes on with the intervals left and right of it, until no bound reaches
the ``k``-th best score found. Intervals that equal it are opened too, as a tie goes to the smaller id. The best of all shards are ranked in Spark, which cuts
each task's rows to ``k`` a query before the shuffle.

Terms are told apart by 64 bits of a hash. Nothing is collected but the slots of the gate and two totals.

Rules for odd input: a null or empty text has no terms, is not counted and never found; an item without terms has no
results; rows of equal id are documents of their own, and a null id comes last among equal scores; items that share id and text are one, items that
share an id only are ranked apart; empty tables give an empty result; other columns are not read.
"""

from __future__ import annotations

import heapq
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import small_batches, staged

BEST = 20
#: The weights of the score, and the unit of an impact.
UNIT, SATURATION, LENGTH_SHARE, WEIGHT_UNIT = 1_000_000_000, 12, 25, 1000
#: Slots that a document's terms must hit to be kept; all are passed on if queries fill them.
GATE_SLOTS = 1 << 20
SHARD_DOCS, BLOCK_ITEMS = 8192, 256
#: Intervals that are opened together.
BATCH_INTERVALS = 64
SEGMENT = 1 << 20
KNOWN_WORDS = 300_000
NO_ID = (1 << 63) - 1

#: Lower-cases A to Z and puts spaces for what no term has: ASCII but digits and letters.
_TABLE = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or chr(b).isalnum() else ord(" ") for b in range(256)
)
_TERMS = pa.schema(
    [("doc", pa.int64()), ("doc_id", pa.int64()), ("n", pa.int64()), ("keys", pa.list_(pa.int64())), ("tfs", pa.list_(pa.int64()))]
)
_TERMS_SQL = "doc long, doc_id long, n long, keys array<long>, tfs array<long>"


def term_counts(text: str | None) -> tuple[Counter, int]:
    """How often each term occurs in a text, and all occurrences."""
    data = (text or "").encode("utf-8", "replace").translate(_TABLE)
    if len(data) <= SEGMENT:
        words = data.split()
        return Counter(words), len(words)
    counts, start, n = Counter(), 0, 0
    while start < len(data):
        stop = data.find(b" ", start + SEGMENT)
        words = data[start : stop if stop >= 0 else len(data)].split()
        counts.update(words)
        n += len(words)
        start = stop if stop >= 0 else len(data)
    return counts, n


def _signed(hashed: int) -> int:
    return hashed - (1 << 64) if hashed >> 63 else hashed


class TermKeys(dict):
    """The key of a term, or None if the gate does not let it through."""

    def __init__(self, gate: np.ndarray | None):
        super().__init__()
        self.gate = gate

    def __missing__(self, term: bytes) -> int | None:
        if len(self) > KNOWN_WORDS:
            self.clear()
        hashed = xxhash.xxh3_64_intdigest(term)
        passes = self.gate is None or self.gate[hashed % GATE_SLOTS]
        self[term] = key = _signed(hashed) if passes else None
        return key


def _terms(docs: DataFrame, gate: np.ndarray | None) -> DataFrame:
    """doc_id, n, and keys with their counts, of every row."""

    def terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key_of = TermKeys(gate)
        for batch in batches:
            rows = []
            for doc, doc_id, text in zip(*(batch.column(c).to_pylist() for c in ("doc", "doc_id", "text")), strict=True):
                counts, n = term_counts(text)
                kept = [(key, tf) for term, tf in counts.items() if (key := key_of[term]) is not None]
                rows.append((doc, doc_id, n, [key for key, _ in kept], [tf for _, tf in kept]))
            columns = zip(*rows, strict=True) if rows else [[] for _ in _TERMS]
            yield pa.RecordBatch.from_arrays(
                [pa.array(values, field.type) for values, field in zip(columns, _TERMS, strict=True)], schema=_TERMS
            )

    small_batches(docs.sparkSession)
    return docs.mapInArrow(terms, _TERMS_SQL)


class Shard:
    """Posting lists of a shard with their sparse tables. Documents are numbered from 0 in the order of their lengths."""

    def __init__(self, n_docs: int, terms: np.ndarray, docs: np.ndarray, impacts: np.ndarray):
        """``terms``, ``docs`` and ``impacts`` of all postings; terms are numbered."""
        order = np.lexsort((docs, terms))
        self.n_docs, self.docs, self.place = n_docs, docs[order], terms[order].astype(np.int64) * (n_docs + 1) + docs[order]
        # levels[j][i]: the place of the largest impact among the 2**j postings from i on.
        self.impacts = impacts[order]
        size = len(self.impacts)
        longest = int(np.bincount(terms).max()) if size else 1
        self.levels = [np.arange(size, dtype=np.int32)]
        while (step := 1 << (len(self.levels) - 1)) * 2 <= longest:
            last = self.levels[-1]
            other = last[np.minimum(np.arange(size) + step, size - 1)]
            self.levels.append(np.where(self.impacts[other] > self.impacts[last], other, last))
        self.levels = np.stack(self.levels) if size else np.zeros((1, 0), dtype=np.int32)

    def maxima(self, terms: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each term (row) and interval of documents (column): the largest impact, and its document."""
        base = terms[:, None] * (self.n_docs + 1)
        low = np.searchsorted(self.place, base + starts)
        high = np.searchsorted(self.place, base + stops)
        count = high - low
        some = count > 0
        level = np.frexp(np.maximum(count, 1))[1] - 1
        last = max(0, len(self.impacts) - 1)
        one = self.levels[level, np.minimum(low, last)]
        two = self.levels[level, np.clip(high - (1 << level), 0, last)]
        best = np.where(self.impacts[two] > self.impacts[one], two, one)
        return np.where(some, self.impacts[best], 0), self.docs[best]

    def search(self, terms: np.ndarray, weights: np.ndarray, ids: np.ndarray, k: int) -> list[tuple[int, int]]:
        """The ``k`` best documents as (score, number), equal scores by ``ids`` and then number. Weights hold how often the query has a term."""
        if len(terms) == 0 or len(self.impacts) == 0:
            return []
        best: list[tuple[int, int, int]] = []  # a heap of (score, -id, -number)
        weights = weights[:, None]

        def bounded(starts: np.ndarray, stops: np.ndarray) -> None:
            maxima, at = self.maxima(terms, starts, stops)
            parts = maxima * weights
            bounds = parts.sum(axis=0)
            split = at[parts.argmax(axis=0), np.arange(len(starts))]
            for bound, start, stop, doc in zip(bounds.tolist(), starts.tolist(), stops.tolist(), split.tolist(), strict=True):
                if bound > 0 and (len(best) < k or bound >= best[0][0]):
                    heapq.heappush(intervals, (-bound, start, stop, doc))

        intervals: list[tuple[int, int, int, int]] = []
        bounded(np.array([0]), np.array([self.n_docs]))
        while intervals and (len(best) < k or -intervals[0][0] >= best[0][0]):
            taken = []
            while intervals and len(taken) < BATCH_INTERVALS and (len(best) < k or -intervals[0][0] >= best[0][0]):
                taken.append(heapq.heappop(intervals))
            docs = np.array([doc for *_, doc in taken])
            scores = (self.maxima(terms, docs, docs + 1)[0] * weights).sum(axis=0)
            for score, doc in zip(scores.tolist(), docs.tolist(), strict=True):
                found = (score, -int(ids[doc]), -doc)
                if len(best) < k:
                    heapq.heappush(best, found)
                elif found > best[0]:
                    heapq.heapreplace(best, found)
            halves = [(s, d) for _, s, _, d in taken if s < d] + [(d + 1, e) for _, _, e, d in taken if d + 1 < e]
            if halves:
                bounded(*np.array(halves).T)
        return [(score, -doc) for score, _, doc in sorted(best, reverse=True)]


def _searched(k: int):
    def search(postings: pd.DataFrame, items: pd.DataFrame) -> pd.DataFrame:
        found = []
        if len(postings) and len(items):
            docs = postings.sort_values(["n", "doc"])
            keys = np.concatenate(docs["keys"].to_numpy())
            known, terms = np.unique(keys, return_inverse=True)
            sizes = docs["keys"].map(len).to_numpy()
            impacts = np.concatenate(docs["impacts"].to_numpy()).astype(np.int64)
            shard = Shard(len(docs), terms, np.repeat(np.arange(len(docs)), sizes), impacts)
            ids, order_ids = docs["doc_id"].tolist(), docs["order_id"].to_numpy()
            for item, item_id, query_keys, weights in zip(
                items["item"], items["item_id"], items["keys"], items["weights"], strict=True
            ):
                at = np.minimum(np.searchsorted(known, query_keys), len(known) - 1)
                here = known[at] == query_keys
                best = shard.search(at[here], np.asarray(weights)[here].astype(np.int64), order_ids, k)
                found += [(item, item_id, ids[doc], score) for score, doc in best]
        out = pd.DataFrame(found, columns=["item", "item_id", "doc_id", "score"])
        return out.astype({"item_id": "Int64", "doc_id": "Int64"})

    return search


def search(docs: DataFrame, items: DataFrame, k: int = BEST) -> DataFrame:
    """The ``k`` best documents of each item: item_id, rank, doc_id, score."""
    queries = items.select(F.col("item_id").cast("long").alias("doc_id"), F.col("text").cast("string")).distinct()
    # Items are few beside documents, but may be any number: they are numbered by row where they are stored.
    queries = staged(queries.withColumn("doc", F.monotonically_increasing_id()), "items")
    asked = staged(_terms(queries, None).filter("n > 0"), "asked").select(
        F.col("doc").alias("item"), F.col("doc_id").alias("item_id"), F.arrays_zip("keys", "tfs").alias("terms")
    )
    blocks = max(1, -(-asked.count() // BLOCK_ITEMS))
    asked = asked.withColumn("block", F.pmod(F.xxhash64("item"), F.lit(blocks))).select(
        "item", "item_id", "block", F.explode("terms").alias("term")
    ).select("item", "item_id", "block", F.col("term.keys").alias("key"), F.col("term.tfs").alias("query_tf"))

    gate = np.zeros(GATE_SLOTS, dtype=bool)
    slots = asked.select(F.col("key").bitwiseAND(GATE_SLOTS - 1).alias("slot")).distinct()
    gate[[row.slot for row in slots.collect()]] = True

    rows = docs.select(
        F.monotonically_increasing_id().alias("doc"), F.col("doc_id").cast("long"), F.col("text").cast("string")
    )
    terms = staged(_terms(rows, gate).filter("n > 0"), "terms")
    totals = terms.agg(F.count(F.lit(1)).alias("docs"), F.coalesce(F.sum("n"), F.lit(0)).alias("terms")).first()
    n_docs, n_terms = totals["docs"], totals["terms"]

    holding = terms.select(F.explode("keys").alias("key")).groupBy("key").agg(F.count(F.lit(1)).alias("df"))
    weight = F.floor(F.lit(WEIGHT_UNIT) * F.log(F.lit(2.0 * n_docs + 2.0) / (F.col("df") * F.lit(2.0) + F.lit(1.0))))
    weighted = staged(asked.join(holding, "key").withColumn("weight", F.col("query_tf") * weight), "weighted")
    return _ranked(weighted, terms, n_docs, n_terms, blocks, k)


def _ranked(weighted: DataFrame, terms: DataFrame, n_docs: int, n_terms: int, blocks: int, k: int) -> DataFrame:
    shards = max(1, -(-n_docs // SHARD_DOCS))
    shard = F.pmod(F.xxhash64("doc"), F.lit(shards)).cast("int")
    queries = weighted.groupBy("block", "item", "item_id").agg(
        F.collect_list(F.struct("key", "weight")).alias("terms")  # the terms of one query
    ).select(
        F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("of_shard"),
        F.col("block").alias("of_block"), "item", "item_id",
        F.col("terms.key").alias("keys"), F.col("terms.weight").alias("weights"),
    )

    length = F.expr(
        f"CAST({100 - LENGTH_SHARE} + (CAST({LENGTH_SHARE} AS DECIMAL(38,0)) * n * {n_docs}L) DIV {max(1, n_terms)}L AS BIGINT)"
    )
    impact = F.expr(
        f"transform(tfs, tf -> ({UNIT}L * tf) DIV ({WEIGHT_UNIT}L * tf + {SATURATION}L * m))"
    )
    postings = terms.filter(F.size("keys") > 0).withColumn("m", length).select(
        shard.alias("shard"), "doc", "doc_id", F.coalesce("doc_id", F.lit(NO_ID)).alias("order_id"), "n",
        "keys", impact.alias("impacts"),
    )
    if blocks == 1:
        postings = postings.withColumn("block", F.lit(0).cast("long"))
    else:
        postings = _by_block(postings, weighted)
    found = (
        postings.groupBy("shard", "block")
        .cogroup(queries.groupBy("of_shard", "of_block"))
        .applyInPandas(_searched(k), "item long, item_id long, doc_id long, score long")
    )
    best = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    ranked = found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
    return ranked.select("item_id", "rank", "doc_id", "score")


def _by_block(postings: DataFrame, weighted: DataFrame) -> DataFrame:
    """Documents once for every block that asks for one of their terms, with its terms only."""
    asked = weighted.select("key", "block").distinct()
    each = postings.select(
        "shard", "doc", "doc_id", "order_id", "n", F.explode(F.arrays_zip("keys", "impacts")).alias("posting")
    ).select("shard", "doc", "doc_id", "order_id", "n", F.col("posting.keys").alias("key"), F.col("posting.impacts").alias("impact"))
    return (
        each.join(asked, "key")
        .groupBy("shard", "block", "doc", "doc_id", "order_id", "n")
        .agg(F.collect_list(F.struct("key", "impact")).alias("terms"))  # the terms of one document
        .select("shard", "block", "doc", "doc_id", "order_id", "n", F.col("terms.key").alias("keys"), F.col("terms.impact").alias("impacts"))
    )
