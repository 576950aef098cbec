"""Phrase collocations by Toivonen mining: a sample proposes, full passes count exactly.

A phrase is a run of words inside a piece of text between marks, of up to ``longest`` words, and is frequent with ``least``
occurrences in its language. A sample of the documents, at a lowered threshold, proposes phrases. A full pass counts
these and their negative border: phrases that are not proposed, but whose first and whose last words, all but one, are. In
other words, it counts what occurs between proposed parts, and every single word. A frequent phrase that was not proposed
is a border failure: longer phrases around it may be frequent too and were not counted. It joins the proposals, and another
pass counts what that adds, until nothing fails. A shortest frequent phrase that was never counted would have a frequent
part that was counted and not proposed, so nothing is missed, whatever the sample is.

Proposals are marked in a bitmap of at most ``MAX_BITS`` bits, which is broadcast. A phrase that shares a mark is
counted without need, which costs time only; a full bitmap lets everything be counted. Phrases go through the shuffle as
61 bits of a hash and a length, added up in each task first, so the commonest phrase is a row per task. The words of the
frequent ones are looked up in the sample, and those of the few that it does not have in a last pass.

Rules for odd input: a null language is ``und``; a null or empty text has no words; a text is split
whole, in blocks; rows that repeat count as often as they come; an empty table gives an empty result; of other columns only
``doc_id`` is read, if there is one, to draw the sample.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.broadcast import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.bytewords import bytes_among, hashed_words
from tidemark.llm.common import small_batches, staged
from tidemark.llm.shingles import _MULTIPLIER, _mixed

LEAST, LONGEST, TOP = 30, 4, 2000
#: One document in so many is sampled, and a phrase proposed if the sample has it so often.
SAMPLE_SHARE, SAMPLE_LEAST = 16, 2
#: A longer phrase takes the place of one inside it if it is at least so many hundredths as frequent.
PERCENT = 80
#: Fixed value: the score of words that only occur together.
SCALE = 2_000_000
#: Marks a phrase has, and the largest bitmap, 16 MB.
BITS_PER_PHRASE, MAX_BITS, BITMAP_BITS = 32, 1 << 27, 32768

#: Phrases that a task adds up before it hands them on.
HELD_PHRASES = 4_000_000
#: Bytes that are looked at together, and phrases a task remembers as named.
BLOCK_BYTES, NAMED = 1 << 20, 500_000

# Marks that end a piece, and what separates words.
PIECE_MARKS, WORD_SPACES = ".,;:!?\n\x0b\x0c\r", " \t"
NO_LANGUAGE = "und"
#: A byte that UTF-8 never has stands for the end of a piece.
END = b"\xff"
_TABLE = bytes(
    END[0] if chr(b) in PIECE_MARKS else ord(" ") if chr(b) in WORD_SPACES else b + 32 if 65 <= b <= 90 else b
    for b in range(256)
)
_SEPARATING = bytes_among(b" " + END)
#: The low bits of a key are the number of words, none for the words of a whole language.
LENGTH_BITS = 3
_LENGTH_MASK = np.uint64((1 << LENGTH_BITS) - 1)
_COUNTED = pa.schema([("key", pa.int64()), ("n", pa.int64())])


class Block(NamedTuple):
    """Words that are looked at together."""

    data: bytes
    starts: np.ndarray
    stops: np.ndarray
    hashes: np.ndarray
    #: The piece that a word is in, and its language's number among ``names``.
    pieces: np.ndarray
    langs: np.ndarray
    names: list[str]
    #: So many words at the start were in the block before.
    seen: int

    def phrase(self, first: int, length: int) -> str:
        words = (self.data[self.starts[i] : self.stops[i]] for i in range(first, first + length))
        return b" ".join(words).decode("utf-8", "replace")


def _block(parts: list[bytes], langs: list[int], names: list[str], seen: int) -> Block:
    data = END.join(parts)
    starts, stops, hashes = hashed_words(data, _SEPARATING)
    marks = np.flatnonzero(np.frombuffer(data, dtype=np.uint8) == END[0])
    sizes = np.array([len(part) + 1 for part in parts])
    part = np.searchsorted(np.cumsum(sizes), starts, "right")
    return Block(
        data, starts, stops, hashes, np.searchsorted(marks, starts), np.array(langs, dtype=np.int64)[part], list(names), seen
    )


def _last_words(data: bytes, start: int, stop: int, n: int) -> tuple[int, int]:
    """Where the last ``n`` words before ``stop`` begin, and how many there are."""
    found = 0
    while found < n:
        end = stop
        while end > start and data[end - 1 : end] in (b" ", END):
            end -= 1
        if end == start:
            break
        stop = max(data.rfind(b" ", start, end), data.rfind(END, start, end), start - 1) + 1
        found += 1
    return stop, found


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[Block]:
    parts: list[bytes] = []
    langs: list[int] = []
    names: dict[str, int] = {}
    size = seen = 0
    for batch in batches:
        for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist(), strict=True):
            number = names.setdefault(lang, len(names))
            data = (text or "").encode("utf-8", "replace").translate(_TABLE)
            start = cut = 0
            while True:
                # A text that is too long goes on in the next block, with the words that begin phrases across the cut.
                full = max(start + BLOCK_BYTES - size, cut + 1)
                cut = data.find(b" ", full) if len(data) > full else -1
                parts.append(data[start : cut if cut >= 0 else len(data)])
                langs.append(number)
                size += len(parts[-1]) + 1
                if cut < 0:
                    break
                yield _block(parts, langs, list(names), seen)
                start, seen = _last_words(data, start, cut, LONGEST - 1)
                parts, langs, size = [], [], 0
            if size >= BLOCK_BYTES:
                yield _block(parts, langs, list(names), seen)
                parts, langs, size, seen = [], [], 0, 0
    if parts:
        yield _block(parts, langs, list(names), seen)


def _keys(block: Block) -> list[tuple[np.ndarray, np.ndarray]]:
    """By number of words, from 1: a key for each place, and whether a phrase begins there."""
    h, piece = block.hashes, block.pieces
    seeds = np.array([xxhash.xxh3_64_intdigest(name, seed=1) for name in block.names], dtype=np.uint64)
    out = []
    with np.errstate(over="ignore"):
        key = _mixed(h + seeds[block.langs])
        for length in range(1, LONGEST + 1):
            size = max(0, len(h) - length + 1)
            if length > 1:
                key = _mixed(key[:size] * _MULTIPLIER + h[length - 1 :][:size])
            out.append(((key & ~_LENGTH_MASK) | np.uint64(length), piece[:size] == piece[length - 1 :][:size]))
    return out


def language_key(name: str) -> int:
    """The key under which the words of a language are counted."""
    return int(np.int64(np.uint64(xxhash.xxh3_64_intdigest(name, seed=1)) & ~_LENGTH_MASK))


def _slot(keys: np.ndarray, bits: int) -> np.ndarray:
    return (keys >> np.uint64(LENGTH_BITS)) & np.uint64(bits - 1)


def _marked(keys: np.ndarray, marks: np.ndarray) -> np.ndarray:
    slot = _slot(keys, 8 * len(marks))
    return (marks[slot >> np.uint64(3)] >> (slot & np.uint64(7)).astype(np.uint8)) & 1 == 1


def _between(keys: list[tuple[np.ndarray, np.ndarray]], marks: np.ndarray) -> list[np.ndarray]:
    """By number of words: where both parts of a phrase, without its last and without its first word, are marked."""
    out = [np.flatnonzero(keys[0][1])]
    for (shorter, _), (key, inside) in zip(keys, keys[1:], strict=False):
        marked = _marked(shorter, marks)
        out.append(np.flatnonzero(inside & marked[: len(key)] & marked[1 : len(key) + 1]))
    return out


def _newly_between(keys: list[tuple[np.ndarray, np.ndarray]], marks: np.ndarray, fresh: np.ndarray) -> list[np.ndarray]:
    """Of these, where a part is among the ``fresh`` marks, which are few; no single words."""
    out = [np.empty(0, dtype=np.int64)]
    for (shorter, _), (key, inside) in zip(keys, keys[1:], strict=False):
        hit = _marked(shorter, fresh)
        at = np.flatnonzero(inside & (hit[: len(key)] | hit[1 : len(key) + 1]))
        out.append(at[_marked(shorter[at], marks) & _marked(shorter[at + 1], marks)])
    return out


class _Sums:
    """Counts by key; a part that is full is added up and handed on."""

    def __init__(self):
        self.parts: list[np.ndarray] = []
        self.held = 0

    def add(self, keys: np.ndarray) -> Iterator[pa.RecordBatch]:
        self.parts.append(keys)
        self.held += len(keys)
        if self.held >= HELD_PHRASES:
            yield from self.rows()

    def rows(self) -> Iterator[pa.RecordBatch]:
        if self.held:
            keys, n = np.unique(np.concatenate(self.parts), return_counts=True)
            self.parts, self.held = [], 0
            for at in range(0, len(keys), 100_000):
                yield _batch(keys[at : at + 100_000].view(np.int64), n[at : at + 100_000])


def _batch(keys: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(keys), pa.array(n.astype(np.int64))], schema=_COUNTED)


def _counted(texts: DataFrame, proposed: Broadcast | None, before: Broadcast | None = None) -> DataFrame:
    """How often a phrase stands between proposed parts, unless these were proposed ``before``; without proposals, every
    phrase. The first pass counts the words of each language too."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, languages = _Sums(), {}
        fresh = None if before is None else proposed.value & ~before.value
        for block in _blocks(batches):
            keys = _keys(block)
            if proposed is None:
                places = [np.flatnonzero(inside) for _, inside in keys]
            elif before is None:
                places = _between(keys, proposed.value)
            else:
                places = _newly_between(keys, proposed.value, fresh)
            for length, ((key, _), here) in enumerate(zip(keys, places, strict=True), 1):
                # What lies within the words of the block before was counted there.
                yield from sums.add(key[here[here > block.seen - length]])
            if before is None:
                n = np.bincount(block.langs[block.seen :], minlength=len(block.names))
                for name, words in zip(block.names, n.tolist(), strict=True):
                    languages[name] = languages.get(name, 0) + words
        yield from sums.rows()
        found = [(language_key(name), n) for name, n in languages.items() if n]
        yield _batch(np.array([k for k, _ in found], dtype=np.int64), np.array([n for _, n in found], dtype=np.int64))

    # The rows are sums of a task already, so another sum before the shuffle would only cost memory.
    return texts.mapInArrow(count, "key long, n long").repartition("key").groupBy("key").agg(F.sum("n").alias("n"))


def _length() -> Column:
    return F.col("key").bitwiseAND((1 << LENGTH_BITS) - 1)


def _mark(keys: DataFrame, bits: int) -> np.ndarray:
    """The bitmap of some keys, put together by Spark's bitmap functions."""
    slot = F.shiftrightunsigned("key", LENGTH_BITS).bitwiseAND(bits - 1) + F.lit(1)
    parts = (
        keys.select(slot.alias("slot"))
        .groupBy(F.call_function("bitmap_bucket_number", "slot").alias("bucket"))
        .agg(F.call_function("bitmap_construct_agg", F.call_function("bitmap_bit_position", F.col("slot"))).alias("bits"))
    )
    marks = np.zeros(bits // 8, dtype=np.uint8)
    size = BITMAP_BITS // 8
    for row in parts.collect():  # at most MAX_BITS / BITMAP_BITS rows of 4 kB
        marks[(row.bucket - 1) * size : row.bucket * size] = np.frombuffer(row.bits, dtype=np.uint8)
    return marks


def _bits(keys: int) -> int:
    return min(MAX_BITS, max(BITMAP_BITS, 1 << (keys * BITS_PER_PHRASE - 1).bit_length())) if keys else BITMAP_BITS


def _unmarked(found: DataFrame, marks: Broadcast) -> DataFrame:
    """Phrases that can be part of a longer one and are not proposed."""

    def failing(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column("key").to_numpy().view(np.uint64)
            yield batch.filter(pa.array(~_marked(keys, marks.value)))

    return found.filter(_length().between(1, LONGEST - 1)).select("key").mapInArrow(failing, "key long")


def frequent(texts: DataFrame, sample: DataFrame, least: int) -> DataFrame:
    """``key`` and ``n`` of every frequent phrase, and of every language."""
    sc = texts.sparkSession.sparkContext
    proposals = staged(
        _counted(sample, None).filter((F.col("n") >= SAMPLE_LEAST) & _length().between(1, LONGEST - 1)).select("key"), "proposed"
    )
    marks = _mark(proposals, _bits(proposals.count()))
    before, now = None, sc.broadcast(marks)
    found = None
    while True:
        counts = _counted(texts, now, before).filter((F.col("n") >= least) | (_length() == 0))
        counts = staged(counts, "counted")
        found = counts if found is None else found.unionByName(counts)
        # Phrases of an earlier pass are marked by now.
        failed = staged(_unmarked(counts, now), "failed")
        if failed.isEmpty():
            return found
        marks = marks | _mark(failed, 8 * len(marks))
        before, now = now, sc.broadcast(marks)


_NAMED_SQL = "key long, lang_key long, lang string, phrase string, firsts array<long>, rests array<long>, inner array<long>"


def _lists(columns: list[np.ndarray], rows: int) -> pa.ListArray:
    """A list per row of what the columns have there."""
    values = np.stack(columns, axis=1).ravel() if columns else np.empty(0, dtype=np.int64)
    return pa.ListArray.from_arrays(pa.array(np.arange(rows + 1, dtype=np.int32) * len(columns)), pa.array(values))


def _named_batch(block: Block, signed: list[np.ndarray], length: int, at: np.ndarray) -> pa.RecordBatch:
    langs, lang_keys = block.names, np.array([language_key(name) for name in block.names])
    lang = block.langs[at]
    columns = {
        "key": pa.array(signed[length - 1][at]),
        "lang_key": pa.array(lang_keys[lang]),
        "lang": pa.array([langs[i] for i in lang.tolist()], pa.string()),
        "phrase": pa.array([block.phrase(i, length) for i in at.tolist()], pa.string()),
        "firsts": _lists([signed[n - 1][at] for n in range(1, length)], len(at)),
        "rests": _lists([signed[length - n - 1][at + n] for n in range(1, length)], len(at)),
        "inner": _lists([signed[n - 1][at + i] for n in range(2, length) for i in range(length - n + 1)], len(at)),
    }
    return pa.RecordBatch.from_pydict(columns)


def _named(texts: DataFrame, marks: Broadcast) -> DataFrame:
    """The words of marked phrases of two and more words, with the keys of their cuts and of the phrases inside."""

    def name(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = np.empty(0, dtype=np.uint64)
        for block in _blocks(batches):
            keys = _keys(block)
            signed = [key.view(np.int64) for key, _ in keys]
            for length in range(2, LONGEST + 1):
                key, inside = keys[length - 1]
                places = np.flatnonzero(inside)
                places = places[_marked(key[places], marks.value)]
                found, firsts = np.unique(key[places], return_index=True)
                fresh = ~np.isin(found, known, assume_unique=True)
                if fresh.any():
                    known = found if len(known) > NAMED else np.concatenate([known, found[fresh]])
                    yield _named_batch(block, signed, length, places[firsts[fresh]])

    return texts.mapInArrow(name, _NAMED_SQL).dropDuplicates(["key"])


def named(texts: DataFrame, sample: DataFrame, phrases: DataFrame) -> DataFrame:
    """Frequent phrases with their words. Most are found in the sample already; all documents are asked for the others only."""
    sc = texts.sparkSession.sparkContext
    marks = sc.broadcast(_mark(phrases, _bits(phrases.count())))
    early = staged(_named(sample, marks).join(phrases, "key"), "early")
    rest = staged(phrases.join(early, "key", "left_anti"), "unnamed")
    marks = sc.broadcast(_mark(rest, _bits(rest.count())))
    return early.unionByName(staged(_named(texts, marks).join(rest, "key"), "late"))


def _exact(name: str) -> Column:
    return F.col(name).cast("decimal(38,0)")


def collocations(docs: DataFrame, least: int = LEAST, top: int = TOP, share: int = SAMPLE_SHARE) -> DataFrame:
    """The ``top`` phrases of each language: lang, rank, phrase, a, l, r, n, score.

    Of the cuts of a phrase in two, the one whose parts occur most often without each other counts: ``a`` are the
    occurrences of the phrase, ``l`` and ``r`` those of the parts, and the score is 2,000,000 a / (l + r), rounded down.
    A phrase inside a longer frequent one that is at least 80 hundredths as frequent is left out.
    """
    small_batches(docs.sparkSession)
    text, lang = F.coalesce(F.col("text"), F.lit("")), F.coalesce(F.col("lang"), F.lit(NO_LANGUAGE))
    told_apart = [c for c in ("doc_id", "text", "lang") if c in docs.columns]
    drawn = F.pmod(F.xxhash64(*told_apart), F.lit(share)) == 0
    columns = (text.cast("string").alias("text"), lang.cast("string").alias("lang"))
    texts, sample = docs.select(*columns), docs.filter(drawn).select(*columns)

    found = staged(frequent(texts, sample, least), "frequent")
    phrases = named(texts, sample, found.filter(_length() >= 2).withColumnRenamed("n", "a"))

    firsts = found.select(F.col("key").alias("first_key"), F.col("n").alias("l"))
    rests = found.select(F.col("key").alias("rest_key"), F.col("n").alias("r"))
    cuts = phrases.select("key", "a", F.posexplode(F.arrays_zip("firsts", "rests")).alias("k", "cut")).select(
        "key", "a", "k", F.col("cut.firsts").alias("first_key"), F.col("cut.rests").alias("rest_key")
    )
    score = F.expr(f"CAST({SCALE} AS DECIMAL(38,0)) * CAST(a AS DECIMAL(20,0)) DIV (CAST(l AS DECIMAL(38,0)) + r)")
    weakest = (
        cuts.join(firsts, "first_key")
        .join(rests, "rest_key")
        .groupBy("key")
        .agg(F.min(F.struct(score.cast("long").alias("score"), "k", "l", "r")).alias("cut"))
        .select("key", "cut.*")
    )
    around = (
        phrases.select(F.explode("inner").alias("inner_key"), F.col("a").alias("longer"))
        .groupBy("inner_key")
        .agg(F.max("longer").alias("longer"))
    )
    totals = found.filter(_length() == 0).select(F.col("key").alias("lang_key"), "n")
    kept = (
        phrases.select("key", "lang_key", "lang", "phrase", "a")
        .join(around, F.col("key") == F.col("inner_key"), "left")
        .filter(F.col("longer").isNull() | (_exact("longer") * 100 < _exact("a") * PERCENT))
        .join(weakest, "key")
    )
    best = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = kept.withColumn("rank", F.row_number().over(best).cast("long")).filter(F.col("rank") <= top)
    return ranked.join(totals, "lang_key").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
