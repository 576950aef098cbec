"""Substring dedup by sliding spans of sentences.

A text is cut into sentences. From every sentence a span runs over the following ones until it has at least
``MIN_SENTENCES`` sentences and ``MIN_WORDS`` words, and to every sentence one runs back over those before it; a sentence of
``LONE_WORDS`` words is a span by itself too. Every longer run is covered by such spans inside it, so a repeated run of sentences
goes from its first sentence to its last. The spans are hashed to 128 bits over their words in lower case and joined globally. Of equal spans the first, by doc_id and then place in the text,
stays; all sentences that any other one covers are removed, and the rest of the text stays as it is.

Only repeated hashes are joined back to their spans, and the first place of each is found by an aggregate that is
combined before the shuffle, so a span that a third of all documents share is not gathered anywhere.

Rules for odd input: null texts stay null; a text without a span is never touched; a null id comes after all
others; rows that share id and text are one document, so they keep or lose the same sentences; an empty table gives an empty
result; of the other columns none is read or changed.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import as_row, staged

MIN_SENTENCES = 2
MIN_WORDS = 20
LONE_WORDS = 40
#: Ranges to remove are broadcast to the documents up to this number, 32 MB of them.
BROADCAST_RANGES = 1_000_000
NO_ID = (1 << 63) - 1

#: A sentence: up to the end marks that white space follows, or to the end of the line, with the space after it.
SENTENCE = re.compile(r"\s*\S.*?(?:[.!?]+(?=\s)\s*|\n\s*|\Z)", re.DOTALL)

RANGES = "array<struct<first:int,after:int>>"


def sentences_of(text: str | None) -> list[str]:
    """The sentences; put together they are the text, unless it has no more than white space."""
    if not text:
        return []
    return SENTENCE.findall(text)


def spans_of(sentences: list[str]) -> Iterator[tuple[int, int, bytes]]:
    """(first sentence, sentence after the last, digest) of every span."""
    words = [s.lower().split() for s in sentences]
    sizes = [len(w) for w in words]
    joined = [" ".join(w).encode("utf-8", "surrogatepass") for w in words]
    digest = lambda first, after: xxhash.xxh3_128_digest(b" ".join(joined[first:after]))
    forward = [0] * len(sizes)
    total = after = 0
    for first, size in enumerate(sizes):
        if after < first:
            total, after = 0, first
        while after < len(sizes) and (total < MIN_WORDS or after - first < MIN_SENTENCES):
            total += sizes[after]
            after += 1
        if size >= LONE_WORDS:
            yield first, first + 1, digest(first, first + 1)
        if total >= MIN_WORDS and after - first >= MIN_SENTENCES:
            forward[first] = after
            yield first, after, digest(first, after)
        total -= size
    # The shortest span that ends with a sentence, unless it is the one that its first sentence has.
    total = first = 0
    for after, size in enumerate(sizes, 1):
        total += size
        while after - first > MIN_SENTENCES and total - sizes[first] >= MIN_WORDS:
            total -= sizes[first]
            first += 1
        if total >= MIN_WORDS and after - first >= MIN_SENTENCES and forward[first] != after:
            yield first, after, digest(first, after)


def _spans(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        rows = []
        for doc_id, key, text in zip(batch["order_id"], batch["text_key"], batch["text"], strict=True):
            for first, after, digest in spans_of(sentences_of(text)):
                high, low = int.from_bytes(digest[:8], "big", signed=True), int.from_bytes(digest[8:], "big", signed=True)
                rows.append((high, low, doc_id, key, first, after))
            if len(rows) >= 50_000:
                yield pd.DataFrame(rows, columns=["high", "low", "order_id", "text_key", "first", "after"])
                rows = []
        if rows:
            yield pd.DataFrame(rows, columns=["high", "low", "order_id", "text_key", "first", "after"])


def _keyed(id_col: str = "doc_id") -> tuple[Column, Column]:
    """The id that orders documents, and a key of the text."""
    return (
        F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)).alias("order_id"),
        F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_key"),
    )


def removed_ranges(docs: DataFrame) -> DataFrame:
    """order_id, text_key and the sentence ranges that the document loses, only where there are any."""
    spans = staged(
        docs.select(*_keyed(), "text").mapInPandas(
            _spans, "high long, low long, order_id long, text_key long, first int, after int"
        ),
        "spans",
    )
    repeated = staged(
        spans.groupBy("high", "low")
        .agg(F.count(F.lit(1)).alias("places"), F.min("order_id").alias("first_id"))
        .filter("places > 1")
        .select(F.col("high").alias("of_high"), F.col("low").alias("of_low"), "first_id"),
        "repeated-spans",
    )
    met = staged(
        spans.join(repeated, (F.col("high") == F.col("of_high")) & (F.col("low") == F.col("of_low"))).drop("of_high", "of_low"),
        "met",
    )
    # In the first document the first place stays; only its own places are compared.
    inside = Window.partitionBy("high", "low", "order_id").orderBy("text_key", "first")
    again = met.filter("order_id = first_id").withColumn("place", F.rank().over(inside)).filter("place > 1")
    elsewhere = met.filter("order_id > first_id")
    columns = ("order_id", "text_key", "first", "after")
    return (
        elsewhere.select(*columns)
        .unionByName(again.select(*columns))
        .groupBy("order_id", "text_key")
        .agg(F.collect_set(F.struct("first", "after")).alias("ranges"))
    )


def _removal(texts: pd.Series, ranges: pd.Series) -> Iterator[tuple]:
    for text, spans in zip(texts, ranges, strict=True):
        sentences = sentences_of(text)
        gone = [False] * len(sentences)
        for span in spans if spans is not None else ():
            for k in range(span["first"], span["after"]):
                gone[k] = True
        yield "".join(s for s, g in zip(sentences, gone, strict=True) if not g), len(sentences), sum(gone)


def dedup(docs: DataFrame) -> DataFrame:
    """``doc`` (all columns as a struct) and ``found``: the text that stays, sentences, and how many of them went."""

    @F.pandas_udf("struct<text:string,n_sentences:int,n_removed:int>")
    def removed(parts: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for texts, ranges in parts:
            yield pd.DataFrame(list(_removal(texts, ranges)), columns=["text", "n_sentences", "n_removed"])

    ranges = staged(removed_ranges(docs), "ranges")
    size = ranges.agg(F.sum(F.size("ranges"))).first()[0] or 0
    ranges = ranges.withColumnsRenamed({"order_id": "of_id", "text_key": "of_key"})
    if size <= BROADCAST_RANGES:
        ranges = F.broadcast(ranges)
    rows = docs.select(as_row(docs), "text", *_keyed())
    met = rows.join(ranges, (F.col("order_id") == F.col("of_id")) & (F.col("text_key") == F.col("of_key")), "left")
    none = F.from_json(F.lit("[]"), RANGES)
    found = met.withColumn("found", removed("text", F.coalesce("ranges", none)))
    # A text that loses nothing stays as it is, also where it is no more than white space.
    kept = F.when(F.col("found.n_removed") > 0, F.col("found.text")).otherwise(F.col("text"))
    return found.select("doc", F.struct(kept.alias("text"), "found.n_sentences", "found.n_removed").alias("found"))
