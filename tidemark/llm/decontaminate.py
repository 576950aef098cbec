"""Benchmark decontamination by greedy string tiling.

Seeds are runs of ``MIN_MATCH`` tokens, told by a rolling Karp-Rabin hash. Those of the benchmark fill a gate of a fixed size;
of every document, the stretches of tokens whose seeds all pass it are kept, which most documents have none of. Documents
and items are then joined in Spark by seeds. To be covered up to ``THRESHOLD`` an item needs so many of its seeds in a document, so
its commonest seeds, up to one less than that, need not be joined: a phrase that many items begin with makes no pairs.

Each pair of a document and an item is tiled by itself. The longest run of tokens that is unmarked in both is marked as a tile,
the first in the document and then in the item if there are several, and so on down to runs of ``MIN_MATCH``. Lengths are found by
bisection over the hashes of all unmarked runs of a length, so a pair needs memory in proportion to its tokens, periodic or not.
Coverage is the share of the item's tokens under tiles, so passages that were cut up and reordered are
caught as well. A document is contaminated by an item if coverage reaches ``THRESHOLD``.

Rules for odd input: null and empty texts match nothing; a text of any length is read whole, in segments; an item shorter than a
seed is matched as a whole, if it has a token; a repeated item row is tiled once; repeated documents are matched each; an empty
benchmark contaminates nothing; other columns are untouched.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import as_row, small_batches, staged
from tidemark.llm.shingles import _mixed

MIN_MATCH = 4
THRESHOLD = 0.5
#: Slots of the gate, 2 MB.
GATE_BITS = 1 << 24
#: Characters of a text that are split at once, and tokens that a task remembers.
SEGMENT, KNOWN_TOKENS = 1 << 20, 300_000
#: Texts to remove are broadcast up to this number.
BROADCAST_TEXTS = 1_000_000

TOKEN = re.compile(r"\w+")
SPACE = re.compile(r"\s")
BASE = np.uint64(0x9E3779B97F4A7C15)
MATCH = "item_id long, coverage double, n_tiles int, longest int"


class TokenHashes(dict):
    """64-bit hashes of tokens, each computed once."""

    def __missing__(self, token: str) -> int:
        if len(self) > KNOWN_TOKENS:
            self.clear()
        self[token] = hashed = xxhash.xxh3_64_intdigest(token.encode("utf-8", "surrogatepass")) | 1
        return hashed


def token_hashes(text: str | None, hashes: TokenHashes) -> np.ndarray:
    """The tokens of a text as odd numbers."""
    parts, start = [np.empty(0, dtype=np.uint64)], 0
    while text and start < len(text):
        found = SPACE.search(text, start + SEGMENT)
        stop = found.start() if found else len(text)
        tokens = TOKEN.findall(text[start:stop].lower())
        parts.append(np.fromiter(map(hashes.__getitem__, tokens), np.uint64, len(tokens)))
        start = stop
    return np.concatenate(parts)


def rolling_hashes(tokens: np.ndarray, length: int) -> np.ndarray:
    """A hash of every run of ``length`` tokens."""
    total = np.full(max(0, len(tokens) - length + 1), length, dtype=np.uint64)
    with np.errstate(over="ignore"):
        for k in range(length):
            total = total * BASE + tokens[k : k + len(total)]
        return _mixed(total)


def seeds_of(tokens: np.ndarray) -> np.ndarray:
    """Seeds of an item, one per place; the whole item if it is shorter."""
    return rolling_hashes(tokens, min(MIN_MATCH, len(tokens))) if len(tokens) else np.empty(0, dtype=np.uint64)


class _Runs:
    """Hashes of all runs of any length of some tokens, from sums over their beginnings."""

    def __init__(self, tokens: np.ndarray):
        n = len(tokens)
        self.tokens = tokens
        with np.errstate(over="ignore"):
            power = np.cumprod(np.concatenate([[np.uint64(1)], np.full(n, BASE, dtype=np.uint64)]), dtype=np.uint64)
            self.sums = np.concatenate([[np.uint64(0)], np.cumsum(tokens * power[:n], dtype=np.uint64)])
        self.power = power

    def of(self, starts: np.ndarray, length: int, most: int) -> np.ndarray:
        """Hashes of the runs that begin at ``starts``, brought to the same power, ``most``."""
        with np.errstate(over="ignore"):
            return _mixed((self.sums[starts + length] - self.sums[starts]) * self.power[most - starts])


def _unmarked(marked: np.ndarray, length: int) -> np.ndarray:
    """Where runs of ``length`` begin that have no marked token."""
    sums = np.concatenate([[0], np.cumsum(marked)])
    return np.flatnonzero(sums[length:] == sums[: len(sums) - length])


def greedy_tiles(item: np.ndarray, doc: np.ndarray) -> list[int]:
    """Lengths of the tiles: the longest unmarked match first, ties by place in the document, then the item."""
    size = len(item) + len(doc)
    # One row of tokens, so that the runs of both are hashed alike.
    runs = _Runs(np.concatenate([item, doc]))
    marked_item, marked_doc = np.zeros(len(item), dtype=bool), np.zeros(len(doc), dtype=bool)

    def matches(length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        i, j = _unmarked(marked_item, length), _unmarked(marked_doc, length)
        a, b = runs.of(i, length, size), runs.of(len(item) + j, length, size)
        in_doc, in_item = np.isin(b, a), np.isin(a, b)
        return i[in_item], a[in_item], j[in_doc], b[in_doc]

    tiles: list[int] = []
    most = min(len(item), len(doc))
    while most >= MIN_MATCH:
        low, high, best = MIN_MATCH, most, None
        while low <= high:
            middle = (low + high) // 2
            found = matches(middle)
            if len(found[0]):
                low, best = middle + 1, (middle, found)
            else:
                high = middle - 1
        if best is None:
            break
        length, (i, a, j, b) = best
        places = defaultdict(list)
        for place, key in zip(i[::-1].tolist(), a[::-1].tolist(), strict=True):
            places[key].append(place)
        for there, key in zip(j.tolist(), b.tolist(), strict=True):
            waiting = places[key]
            # Marked runs stay marked, so each is passed over once.
            while waiting and marked_item[waiting[-1] : waiting[-1] + length].any():
                waiting.pop()
            if waiting and not marked_doc[there : there + length].any():
                here = waiting[-1]
                if np.array_equal(item[here : here + length], doc[there : there + length]):
                    marked_item[here : here + length] = marked_doc[there : there + length] = True
                    tiles.append(length)
        most = length - 1
    return tiles


def _record(schema: str, *columns) -> pa.RecordBatch:
    fields = [part.split() for part in schema.split(", ")]
    kinds = {
        "long": pa.int64(), "int": pa.int32(), "double": pa.float64(), "array<long>": pa.list_(pa.int64()),
        "array<int>": pa.list_(pa.int32()), "binary": pa.binary(),
    }
    arrays = [pa.array(values, kinds[kind]) for values, (_, kind) in zip(columns, fields, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, names=[name for name, _ in fields])


ITEMS = "item long, item_id long, n int, tokens binary, seeds array<long>"


def _items(benchmark: DataFrame) -> DataFrame:
    """The items that have tokens, numbered by row where they are stored."""
    rows = benchmark.select(F.col("item_id").cast("long"), F.col("text").cast("string")).distinct()
    numbered = staged(rows.withColumn("item", F.monotonically_increasing_id()), "benchmark")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = TokenHashes()
        for batch in batches:
            item, item_id, text = (batch.column(name).to_pylist() for name in ("item", "item_id", "text"))
            found = [token_hashes(t, hashes) for t in text]
            kept = [k for k, tokens in enumerate(found) if len(tokens)]
            yield _record(
                ITEMS,
                [item[k] for k in kept],
                [item_id[k] for k in kept],
                [len(found[k]) for k in kept],
                [found[k].tobytes() for k in kept],
                [seeds_of(found[k]).view(np.int64) for k in kept],
            )

    return staged(numbered.mapInArrow(read, ITEMS), "items")


def _gate(items: DataFrame) -> tuple[np.ndarray, list[int]]:
    """The slots of the benchmark's seeds, as many as the gate has at most, and the lengths of the seeds."""
    slot = F.col("seed").bitwiseAND(GATE_BITS - 1)
    seeds = items.select(F.explode("seeds").alias("seed"))
    marks = np.zeros(GATE_BITS // 8, dtype=np.uint8)
    parts = (
        seeds.select((slot + F.lit(1)).alias("slot"))
        .groupBy(F.call_function("bitmap_bucket_number", "slot").alias("bucket"))
        .agg(F.call_function("bitmap_construct_agg", F.call_function("bitmap_bit_position", F.col("slot"))).alias("bits"))
    )
    for row in parts.collect():  # of 4 kB, as many as the gate is long
        size = len(row.bits)
        marks[(row.bucket - 1) * size : row.bucket * size] = np.frombuffer(row.bits, dtype=np.uint8)
    lengths = [row.n for row in items.select(F.least("n", F.lit(MIN_MATCH)).alias("n")).distinct().collect()]
    return marks, sorted(lengths)


def _passes(seeds: np.ndarray, marks: np.ndarray) -> np.ndarray:
    slot = seeds & np.uint64(GATE_BITS - 1)
    return (marks[slot >> np.uint64(3)] >> (slot & np.uint64(7)).astype(np.uint8)) & 1 == 1


def stretches(tokens: np.ndarray, passed: np.ndarray) -> np.ndarray:
    """The tokens of all seeds that passed, each once, with a 0 between stretches that do not overlap."""
    at = np.flatnonzero(passed)
    if not len(at):
        return np.empty(0, dtype=np.uint64)
    begins = at[np.r_[True, np.diff(at) >= MIN_MATCH]]
    ends = at[np.r_[np.diff(at) >= MIN_MATCH, True]] + MIN_MATCH
    parts = []
    for begin, end in zip(begins.tolist(), ends.tolist(), strict=True):
        parts += [tokens[begin:end], np.zeros(1, dtype=np.uint64)]
    return np.concatenate(parts[:-1])


SEEDED = "doc long, doc_id long, text_key long, text_hash long, tokens binary, seeds array<long>"


def _seeded(docs: DataFrame, marks: np.ndarray, lengths: list[int]) -> DataFrame:
    """Documents that have seeds of the benchmark, with their stretches and different seeds."""
    small_batches(docs.sparkSession)

    def seek(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = TokenHashes()
        for batch in batches:
            found = []
            names = ("doc", "doc_id", "text_key", "text_hash", "text")
            for doc, doc_id, key, hashed, text in zip(*(batch.column(c).to_pylist() for c in names), strict=True):
                tokens = token_hashes(text, hashes)
                kept, seeds = np.empty(0, dtype=np.uint64), []
                for length in lengths:
                    rolled = rolling_hashes(tokens, length)
                    passed = _passes(rolled, marks)
                    if passed.any():
                        seeds.append(np.unique(rolled[passed]))
                        if length == MIN_MATCH:
                            kept = stretches(tokens, passed)
                if seeds:
                    found.append((doc, doc_id, key, hashed, kept.tobytes(), np.concatenate(seeds).view(np.int64)))
            yield _record(SEEDED, *(zip(*found, strict=True) if found else [[]] * 6))

    rows = docs.select(
        F.monotonically_increasing_id().alias("doc"), F.col("doc_id").cast("long"), *_text_keys(), F.col("text").cast("string")
    )
    return staged(rows.mapInArrow(seek, SEEDED), "seeded")


def _text_keys() -> tuple[Column, Column]:
    """128 bits that stand for a text."""
    return F.xxhash64("text").alias("text_key"), F.xxhash64(F.lit(7), "text", F.length("text")).alias("text_hash")


def _joining_seeds(items: DataFrame, seeded: DataFrame, threshold: float) -> DataFrame:
    """Seeds by which items are found: all but the commonest that cannot cover an item up to the threshold."""
    places = items.select("item", "n", F.explode("seeds").alias("seed")).groupBy("item", "n", "seed").agg(
        F.count(F.lit(1)).alias("places")
    )
    common = seeded.select(F.explode("seeds").alias("seed")).groupBy("seed").agg(F.count(F.lit(1)).alias("documents"))
    # Each tile has at least a seed for every MIN_MATCH tokens that it covers.
    needed = F.greatest(F.ceil(F.col("n") * F.lit(threshold) / F.lit(MIN_MATCH) - F.lit(1e-9)), F.lit(1))
    commonest = Window.partitionBy("item").orderBy(F.desc("documents"), "seed")  # the seeds of one item
    so_far = F.sum("places").over(commonest.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return places.join(common, "seed").withColumn("so_far", so_far).filter(F.col("so_far") >= needed).select("item", "seed")


TILED = f"doc long, doc_id long, text_key long, text_hash long, {MATCH}"


def tiles_in(tokens: np.ndarray, seeds: np.ndarray, item: np.ndarray) -> list[int]:
    """Tiles of an item in a document's stretches, of which only those are looked at that have seeds of the item."""
    if len(item) < MIN_MATCH:
        return [len(item)]
    return greedy_tiles(item, stretches(tokens, np.isin(seeds, rolling_hashes(item, MIN_MATCH))))


def _tiled(met: DataFrame, threshold: float) -> DataFrame:
    def tile(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for row in batch.to_pylist():
                tokens = np.frombuffer(row["tokens"], np.uint64)
                seeds = rolling_hashes(tokens, MIN_MATCH)
                for item in row["items"]:
                    tiles = tiles_in(tokens, seeds, np.frombuffer(item["tokens"], np.uint64))
                    coverage = sum(tiles) / item["n"]
                    if tiles and coverage >= threshold:
                        document = (row["doc"], row["doc_id"], row["text_key"], row["text_hash"])
                        found.append((*document, item["item_id"], coverage, len(tiles), max(tiles)))
            yield _record(TILED, *(zip(*found, strict=True) if found else [[]] * 8))

    return met.mapInArrow(tile, TILED)


def matches(docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """A row per row of ``docs`` and item whose coverage reaches ``threshold``, with 128 bits that stand for the text."""
    items = _items(benchmark)
    marks, lengths = _gate(items)
    seeded = _seeded(docs, marks, lengths)
    keys = staged(_joining_seeds(items, seeded, threshold), "joining-seeds")
    pairs = seeded.select("doc", F.explode("seeds").alias("seed")).join(keys, "seed").select("doc", "item").distinct()
    asked = (
        pairs.join(items.select("item", "item_id", "n", "tokens"), "item")
        .groupBy("doc")
        .agg(F.collect_list(F.struct("item_id", "n", "tokens")).alias("items"))  # items that share seeds with one document
    )
    return staged(_tiled(seeded.drop("seeds").join(asked, "doc"), threshold), "tiled")


def contaminations(docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """A row per document and item whose coverage reaches ``threshold``."""
    return matches(docs, benchmark, threshold).select("doc_id", "item_id", "coverage", "n_tiles", "longest")


def keep_clean(docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` without those that any item contaminates."""
    texts = matches(docs, benchmark, threshold).select(
        F.col("text_key").alias("of_key"), F.col("text_hash").alias("of_hash")
    ).distinct()
    texts = staged(texts, "contaminated")
    if texts.count() <= BROADCAST_TEXTS:
        texts = F.broadcast(texts)
    rows = docs.select(as_row(docs), *_text_keys())
    same = (F.col("text_key") == F.col("of_key")) & (F.col("text_hash") == F.col("of_hash"))
    return rows.join(texts, same, "left_anti").select("doc.*")
