"""Line dedup by an exact set-similarity join.

Lines become sets of words; lines of equal sets are one class from here on. A set of under ``COMPARED_WORDS`` words
can only match an equal one, so its class settles it. Words of the others are ordered by rarity, by the
ranks of the ``SLOTS`` hash slots in which the words of a sample are counted; any order gives the same result. Of two sets with a Jaccard similarity of 0.75, one of the
first ``n - overlap(n, n) + 1`` words of the smaller, in that order, is among the first ``n - ceil(0.75 n) + 1`` of the larger, so
only these prefixes are shuffled, by word, and only the shorter ones look for partners. What a batch of texts sends to one bucket of words is
one row of packed records; lines go the same way to buckets of sets, so that the texts are split once. Among
the sets that meet at a word a pair is a candidate if its sizes fit (length filter), if so many words follow the shared one in both
that the overlap can be reached (positional filter), and if the parities of their words, over 64 to 512 bits by the size of the sets, do not differ in more
bits than the sets may differ in words. Candidates are verified on the full sets.

A line is removed if an earlier line, by doc_id and then place in the text, matches it. One match is enough, so in a first
round a set is compared with the earliest sets at a word until it has ``PARTNERS`` candidates there; sets that have more of them and were not
removed by those meet all their candidates in a second round. The result is that of comparing all lines. A word at which
very many sets meet, as a sample tells, is cut into blocks of sets, and each pair of blocks meets in a task of its own.

Words are split and hashed with array operations over the bytes of many texts at once; a word is 52 bits of its hash.

Rules for odd input: null texts stay null; lines without a word are never touched; a null id comes after all
others; of rows that share id and text one, whichever Spark numbers first, is the first, and the others lose every line with a word; of rows
that share an id only, lines are ordered by place; sets whose first lines share id and place are ordered by their
hashes; a text of any length is split whole, in segments; an empty table gives an empty
result; of the other columns none is read or changed.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.bytewords import bytes_among, hashed_words
from tidemark.llm.common import as_row, small_batches, staged
from tidemark.llm.shingles import PERCENT, _mixed, least_overlap, overlap

#: The smallest set that can match a different one: three words and a fourth.
COMPARED_WORDS = 3
PARTNERS = 8
#: Pairs that a task holds before it keeps the earliest only, or twice those it has kept.
HELD_PAIRS = 1_000_000
#: Rows that a task compares at once, with all rows of their words; sets at one word that are compared in blocks.
MEETING_ROWS, MANY_SETS = 100_000, 2048
#: Sets that meet at one word in one task. So many hundredths of the documents tell which words have more.
HOT_SETS, SAMPLE_SHARE = 100_000, 64
SLOT_BITS, WORD_BITS = 16, 52
SLOTS = 1 << SLOT_BITS
LOW_BITS = WORD_BITS - SLOT_BITS
LOW_MASK, WORD_MASK = np.uint64((1 << LOW_BITS) - 1), np.uint64((1 << WORD_BITS) - 1)
#: Lines that are sorted together: their number takes the bits that a word leaves.
SORTED_LINES = 1 << (64 - WORD_BITS)
#: Prefix rows of a bucket; from so many buckets on they grow, up to so many rows.
BUCKET_ROWS, LEAST_BUCKETS, MANY_BUCKETS, MOST_BUCKET_ROWS = 100_000, 64, 2048, 1_000_000
#: Classes whose sets are compared, and lines to remove, are broadcast up to these numbers.
BROADCAST_CLASSES = 1_000_000
BROADCAST_LINES = 1_000_000
NO_ID = (1 << 63) - 1

#: Bytes hashed at once, few enough to stay in the cache.
SEGMENT = 1 << 16

#: ASCII white space.
_SPACES = bytes_among(b" \t\n\x0b\x0c\r")


class Words(NamedTuple):
    """The words of the lines of some texts: lines are numbered through, empty ones too."""

    line: np.ndarray
    hash: np.ndarray
    #: Of every line: its text, and its place there.
    text_of: np.ndarray
    place_of: np.ndarray


def _texts(batch: pa.RecordBatch) -> list[bytes]:
    return [text or b"" for text in batch.column("text").cast(pa.binary()).to_pylist()]


def _words(texts: list[bytes]) -> Words:
    raw = [text.lower() for text in texts]
    counts = np.array([data.count(b"\n") + 1 for data in raw], dtype=np.int64)
    data = b"\n".join(raw)
    lines, hashes, start, line = [], [], 0, 0
    while start < len(data):
        stop = len(data)
        if stop - start > SEGMENT:
            # Up to white space, so that no word is cut.
            ends = [at for at in (data.find(b" ", start + SEGMENT), data.find(b"\n", start + SEGMENT)) if at >= 0]
            stop = min(ends, default=stop)
        part = data[start:stop]
        starts, _, found = hashed_words(part, _SPACES)
        breaks = np.flatnonzero(np.frombuffer(part, dtype=np.uint8) == 10)
        lines.append(line + np.searchsorted(breaks, starts))
        hashes.append(found)
        line += len(breaks)
        start = stop
    first = np.repeat(np.cumsum(counts) - counts, counts)
    return Words(
        np.concatenate(lines) if lines else np.empty(0, dtype=np.int64),
        np.concatenate(hashes) if hashes else np.empty(0, dtype=np.uint64),
        np.repeat(np.arange(len(raw)), counts),
        np.arange(counts.sum()) - first,
    )


def _sorted_sets(words: Words, ranks: np.ndarray | None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(line, word) of the different words of each line, in the order of the words; by rarity if ``ranks`` are given."""
    bits = words.hash >> np.uint64(64 - WORD_BITS)
    if ranks is not None:
        bits = (ranks[bits >> np.uint64(LOW_BITS)] << np.uint64(LOW_BITS)) | (bits & LOW_MASK)
    last = int(words.line[-1]) + 1 if len(words.line) else 0
    for first in range(0, last, SORTED_LINES):
        here = slice(*np.searchsorted(words.line, [first, first + SORTED_LINES]))
        keys = np.sort((words.line[here] - first).astype(np.uint64) << np.uint64(WORD_BITS) | bits[here])
        if len(keys):
            keys = keys[np.r_[True, keys[1:] != keys[:-1]]]
            yield (keys >> np.uint64(WORD_BITS)).astype(np.int64) + first, keys & WORD_MASK


def _starts(sorted_values: np.ndarray) -> np.ndarray:
    return np.flatnonzero(np.r_[True, sorted_values[1:] != sorted_values[:-1]])


class Sets(NamedTuple):
    """Sets of the lines that have words: the words of set ``i`` are ``words[starts[i]:starts[i] + n[i]]``."""

    line: np.ndarray
    set_id: np.ndarray
    n: np.ndarray
    starts: np.ndarray
    words: np.ndarray


def _sets(words: Words, ranks: np.ndarray | None = None) -> Iterator[Sets]:
    back = None if ranks is None else np.argsort(ranks).astype(np.uint64)
    for line, word in _sorted_sets(words, ranks):
        starts = _starts(line)
        n = np.diff(np.r_[starts, len(line)])
        # Of the words as they are hashed, whatever they are ordered by.
        plain = word if back is None else (back[word >> np.uint64(LOW_BITS)] << np.uint64(LOW_BITS)) | (word & LOW_MASK)
        with np.errstate(over="ignore"):
            set_id = _mixed(np.add.reduceat(_mixed(plain), starts) + n.astype(np.uint64)).view(np.int64)
        yield Sets(line[starts], set_id, n, starts, word)


def _keyed() -> tuple[Column, Column]:
    """The id that orders documents, and a key of the text."""
    return (
        F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("order_id"),
        F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_key"),
    )


def _record(schema: str, *columns) -> pa.RecordBatch:
    names = [part.split()[0] for part in schema.split(", ")]
    return pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c) for c in columns], names=names)


def slot_ranks(sample: DataFrame) -> np.ndarray:
    """The rank of each slot by its words in some documents. A fixed number of ranks comes to the driver."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(SLOTS, dtype=np.int64)
        for batch in batches:
            for sets in _sets(_words(_texts(batch))):
                total += np.bincount((sets.words >> np.uint64(LOW_BITS)).astype(np.int64), minlength=SLOTS)
        yield _record("slot int, words long", np.arange(SLOTS, dtype=np.int32), total)

    counts = sample.select("text").mapInArrow(counted, "slot int, words long")
    ordered = counts.groupBy("slot").agg(F.sum("words").alias("words")).orderBy("words", "slot").select("slot").collect()
    ranks = np.arange(SLOTS, dtype=np.uint64)
    if ordered:
        ranks[[r[0] for r in ordered]] = np.arange(len(ordered), dtype=np.uint64)
    return ranks


#: Words of 64 parity bits for sets from this size up to the next: about as many bits as keep unlike sets apart.
WIDTHS = ((1, COMPARED_WORDS), (2, 41), (4, 101), (8, 251))
WIDEST = WIDTHS[-1][0]


def parities(words: np.ndarray, starts: np.ndarray, width: int) -> np.ndarray:
    """``width`` times 64 bits per set: whether an odd number of its words falls on the bit.

    Half as many bits are the two halves of these, one XOR the other.
    """
    one = np.uint64(1) << (words & np.uint64(63))
    part = (words >> np.uint64(6)) & np.uint64(width - 1)
    return np.stack([np.bitwise_xor.reduceat(np.where(part == k, one, np.uint64(0)), starts) for k in range(width)], axis=1)


LINE = np.dtype([("order_id", "<i8"), ("text_key", "<i8"), ("line", "<i4"), ("set_id", "<i8")])
#: Kinds of rows: lines, and sets at a word by their words of parity, below zero if numbers do not fit into 16 bits.
LINE_KIND = 0


def set_type(kind: int) -> np.dtype:
    """A set at a word: where it meets others, itself, its first place, its size, the word's place, its side of a cut word."""
    number = "<u2" if kind > 0 else "<u4"
    return np.dtype(
        [("key", "<u8"), ("set_id", "<i8"), ("order_id", "<i8"), ("n", number), ("place", number), ("line", number), ("side", "u1")]
        + [("parity", "<u8", (abs(kind),))]
    )


def seeking_words(n: np.ndarray) -> np.ndarray:
    """How many of the first words of a set can lead to sets that are not smaller."""
    return n - -(-PERCENT * 2 * n // (100 + PERCENT)) + 1


def prefix_words(n: np.ndarray) -> np.ndarray:
    return n - -(-PERCENT * n // 100) + 1


class Hot(NamedTuple):
    """Words at which so many sets meet that one task should not compare them, sorted, with their numbers of blocks."""

    word: np.ndarray
    blocks: np.ndarray


def _spread(lengths: np.ndarray) -> np.ndarray:
    """0, 1, 2 and so on up to each length."""
    return np.arange(lengths.sum()) - np.repeat(np.cumsum(lengths) - lengths, lengths)


def _dealt(rows: np.ndarray, hot: Hot) -> np.ndarray:
    """Rows by word, those of hot words once for every pair of blocks that theirs belongs to."""
    if not len(hot.word) or not len(rows):
        return rows
    at = np.minimum(np.searchsorted(hot.word, rows["key"]), len(hot.word) - 1)
    cut = hot.word[at] == rows["key"]
    blocks = np.where(cut, hot.blocks[at], 1)
    other, out = _spread(blocks), np.repeat(rows, blocks)
    own = (_mixed(out["set_id"].view(np.uint64)) % np.repeat(blocks, blocks).astype(np.uint64)).astype(np.int64)
    out["side"] = np.where(own == other, 0, np.where(own < other, 1, 2))
    pair = (np.minimum(own, other) << 32 | np.maximum(own, other)).astype(np.uint64)
    with np.errstate(over="ignore"):
        apart = _mixed(out["key"] + _mixed(pair + np.uint64(1))) | np.uint64(1 << 63)
    out["key"] = np.where(np.repeat(cut, blocks), apart, out["key"])
    return out


def prefix_rows(sets: Sets, order: np.ndarray, place: np.ndarray, hot: Hot) -> Iterator[tuple[int, np.ndarray]]:
    """Kind and rows: one per prefix word of every set that can match another, with the first place of the set among these."""
    by_set = np.lexsort((place, order, sets.set_id))
    first = by_set[_starts(sets.set_id[by_set])]
    for (width, least), (_, beyond) in zip(WIDTHS, (*WIDTHS[1:], (0, NO_ID)), strict=True):
        mine = first[(sets.n[first] >= least) & (sets.n[first] < beyond)]
        if not len(mine):
            continue
        n = sets.n[mine]
        length = prefix_words(n)
        row, at = np.repeat(np.arange(len(mine)), length), _spread(length)
        small = max(int(n.max()), int(place[mine].max())) < 1 << 16
        kind = width if small else -width
        rows = np.zeros(len(row), dtype=set_type(kind))
        rows["key"] = sets.words[sets.starts[mine][row] + at]
        words = sets.words[np.repeat(sets.starts[mine], n) + _spread(n)]
        rows["parity"] = parities(words, np.cumsum(n) - n, width)[row]
        rows["place"] = at
        for name, values in (("set_id", sets.set_id), ("order_id", order), ("n", sets.n), ("line", place)):
            rows[name] = values[mine][row]
        yield kind, _dealt(rows, hot)


def _packed(rows: np.ndarray, ends: np.ndarray) -> pa.Array:
    """Rows as bytes, up to each of the ends."""
    offsets = np.concatenate([[0], ends * rows.dtype.itemsize])
    if offsets[-1] >= 1 << 31:
        raise ValueError("the rows of one batch are over 2 GB; set fewer rows a batch")
    return pa.Array.from_buffers(
        pa.binary(), len(ends), [None, pa.py_buffer(offsets.astype("<i4")), pa.py_buffer(np.ascontiguousarray(rows).view(np.uint8))]
    )


PACKED = "bucket int, kind int, rows binary"


def packed_rows(docs: DataFrame, ranks: np.ndarray, hot: Hot, buckets: int) -> DataFrame:
    """All lines with a word, by set, and all prefix rows, by word; a row here holds those of a batch that go to one bucket."""

    def by_bucket(kind: int, rows: np.ndarray, keys: np.ndarray) -> pa.RecordBatch:
        bucket = (_mixed(keys) % np.uint64(buckets)).astype(np.uint16 if buckets < 1 << 16 else np.int64)
        order = np.argsort(bucket, kind="stable")
        bucket = bucket[order]
        ends = np.r_[_starts(bucket)[1:], len(bucket)]
        return _record(PACKED, bucket[ends - 1].astype(np.int32), np.full(len(ends), kind, dtype=np.int32), _packed(rows[order], ends))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = _words(_texts(batch))
            ids, text_key = (batch.column(c).to_numpy() for c in ("order_id", "text_key"))
            found: dict[int, list[np.ndarray]] = {}
            for sets in _sets(words, ranks):
                text, place = words.text_of[sets.line], words.place_of[sets.line]
                lines = np.zeros(len(text), dtype=LINE)
                for name, values in zip(LINE.names, (ids[text], text_key[text], place, sets.set_id), strict=True):
                    lines[name] = values
                found.setdefault(LINE_KIND, []).append(lines)
                for kind, rows in prefix_rows(sets, ids[text], place, hot):
                    found.setdefault(kind, []).append(rows)
            for kind, parts in found.items():
                rows = np.concatenate(parts)
                keys = rows["set_id"].view(np.uint64) if kind == LINE_KIND else rows["key"]
                yield by_bucket(kind, rows, np.ascontiguousarray(keys))

    return docs.select(*_keyed(), "text").mapInArrow(pack, PACKED)


SINGLE = "key long, set_id long, kind int, rows binary"


def single_rows(docs: DataFrame, ranks: np.ndarray, hot: Hot) -> DataFrame:
    """The prefix rows, each a row."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = _words(_texts(batch))
            ids = batch.column("order_id").to_numpy()
            for sets in _sets(words, ranks):
                for kind, found in prefix_rows(sets, ids[words.text_of[sets.line]], words.place_of[sets.line], hot):
                    key, n = np.ascontiguousarray(found["key"]).view(np.int64), len(found)
                    kinds = np.full(n, kind, dtype=np.int32)
                    yield _record(SINGLE, key, np.ascontiguousarray(found["set_id"]), kinds, _packed(found, np.arange(1, n + 1)))

    return docs.select(*_keyed(), "text").mapInArrow(rows, SINGLE)


class Meeting:
    """Sets that meet at words, and their candidate pairs. Rows are sorted by word, size and set."""

    def __init__(self, parts: list[tuple[np.ndarray, np.ndarray]]):
        """Rows of some kinds, and whether they are asked for."""
        rows = {name: np.concatenate([part[name] for part, _ in parts]) for name in ("key", "set_id", "order_id", "n", "place", "line", "side")}
        asked = np.concatenate([chosen for _, chosen in parts])
        width = np.repeat([part["parity"].shape[1] for part, _ in parts], [len(part) for part, _ in parts])
        parity = np.zeros((len(width), WIDEST), dtype=np.uint64)
        start = 0
        for part, _ in parts:
            parity[start : start + len(part), : part["parity"].shape[1]] = part["parity"]
            start += len(part)
        order = np.lexsort((rows["set_id"], rows["n"], rows["key"]))
        key, set_id = rows["key"][order], rows["set_id"][order]
        new = np.ones(len(order), dtype=bool)
        new[1:] = (key[1:] != key[:-1]) | (set_id[1:] != set_id[:-1])
        if not new.all():
            # Of one set at one word, as from several tasks, the first place counts.
            run = np.cumsum(new) - 1
            several = np.flatnonzero(np.bincount(run)[run] > 1)
            ordered = np.lexsort((rows["line"][order[several]], rows["order_id"][order[several]], run[several]))
            order[several] = order[several][ordered]
            order = order[new]
        rows = {name: column[order] for name, column in rows.items()}
        self.begins = _starts(rows["key"])
        self.sizes = np.diff(np.r_[self.begins, len(order)])
        self.n, self.place, self.line = (rows[name].astype(np.int64) for name in ("n", "place", "line"))
        self.key, self.set_id, self.order_id = rows["key"].view(np.int64), rows["set_id"], rows["order_id"]
        #: Two blocks of one word have sides 1 and 2: pairs within one of them meet elsewhere.
        self.side = rows["side"]
        self.asked, self.width = asked[order], width[order]
        parity, self.halves = parity[order], []
        for width, _ in WIDTHS[:0:-1]:
            self.halves.insert(0, (width, parity))
            parity = parity[:, : width // 2] ^ parity[:, width // 2 :]
        self.folded = parity[:, 0].copy()
        self.seeks = self.place < seeking_words(self.n)

    def _checked(self, i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Those of some pairs that pass all filters, as (later, earlier) rows."""
        a, b = self.n[i], self.n[j]
        needed = -(-PERCENT * (a + b) // (100 + PERCENT))
        good = np.minimum(a - self.place[i], b - self.place[j]) >= needed
        good &= 100 * np.minimum(a, b) >= PERCENT * np.maximum(a, b)
        good &= (self.side[i] == 0) | (self.side[i] != self.side[j])
        i, j, most = i[good], j[good], (a + b - 2 * needed)[good]
        good = np.bitwise_count(self.folded[i] ^ self.folded[j]) <= most
        i, j, most = i[good], j[good], most[good]
        for width, parity in self.halves:
            wide = np.flatnonzero(np.minimum(self.width[i], self.width[j]) >= width)
            if not len(wide):
                break
            differ = np.bitwise_count(parity[i[wide]] ^ parity[j[wide]]).sum(axis=1, dtype=np.int64)
            good = np.ones(len(i), dtype=bool)
            good[wide] = differ <= most[wide]
            i, j, most = i[good], j[good], most[good]
        first = self._before(i, j)
        return np.where(first, j, i), np.where(first, i, j)

    def _before(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Whether the first line of a set comes before that of another."""
        out = self.set_id[i] < self.set_id[j]
        for column in (self.line, self.order_id):
            out = np.where(column[i] == column[j], out, column[i] < column[j])
        return out

    def _few(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pairs at words where few sets meet, for all of these at once, by distance in the order of sizes."""
        few = np.repeat(self.sizes <= MANY_SETS, self.sizes)
        ends = np.repeat(self.begins + self.sizes, self.sizes)
        here, apart = np.flatnonzero(few & self.seeks), 0
        # Sizes grow within a word, so a partner that is too large ends the search; it is at most a third larger.
        largest, most = 100 * self.n // PERCENT, (self.n + 100 * self.n // PERCENT) * (100 - PERCENT) // (100 + PERCENT)
        ends, largest, most, own = ends[here], largest[here], most[here], self.folded[here]
        while len(here):
            apart += 1
            there = here + apart
            fits = there < ends
            fits[fits] = self.n[there[fits]] <= largest[fits]
            if not fits.all():
                here, there, ends, largest, most, own = (x[fits] for x in (here, there, ends, largest, most, own))
            near = np.flatnonzero(np.bitwise_count(own ^ self.folded[there]) <= most)
            if len(near):
                yield self._checked(here[near], there[near])

    def _many(self, begin: int, size: int, all_of_asked: bool) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray | None]]:
        """Pairs at one word where many sets meet: with the earliest sets first, until a set has enough of them.

        Also says which sets were left then.
        """
        rows = np.arange(begin, begin + size)
        rows = rows[np.lexsort((self.set_id[rows], self.line[rows], self.order_id[rows]))]
        if not self.seeks[rows].any():
            return
        found, turn = np.zeros(size, dtype=np.int64), np.empty(size, dtype=np.int64)
        turn[rows - begin] = np.arange(size)
        open_ = np.flatnonzero(self.asked[rows]) if all_of_asked else np.arange(size)
        most = int(2 * self.n[rows].max())
        allowed = np.arange(most + 1) - 2 * -(-PERCENT * np.arange(most + 1) // (100 + PERCENT))
        start, step = 0, 64
        while start < size and len(open_):
            earlier = np.arange(start, min(start + step, size))
            for at in range(0, len(open_), 2048):
                later = open_[at : at + 2048]
                later = later[later > start]
                if not len(later):
                    continue
                x, y = rows[later], rows[earlier]
                differ = np.bitwise_count(self.folded[x][:, None] ^ self.folded[y])
                i, j = np.nonzero(differ <= allowed[self.n[x][:, None] + self.n[y]])
                real = (later[i] > earlier[j]) & np.where(
                    self.n[x[i]] < self.n[y[j]], self.seeks[x[i]], self.seeks[y[j]]
                )
                after, before = self._checked(x[i[real]], y[j[real]])
                np.add.at(found, turn[after - begin], 1)
                yield after, before, None
            if not all_of_asked:
                # A set that has enough candidates meets the rest in the second round, if none of them matches.
                done = found[open_] >= PARTNERS
                yield rows[:0], rows[:0], rows[open_[done]] if start + step < size else rows[:0]
                open_ = open_[~done]
            start, step = start + step, min(2 * step, 512)

    def pairs(self, all_of_asked: bool) -> Iterator[pa.RecordBatch]:
        """later, earlier, more: the earliest partners of every set, or all partners of the sets asked for."""
        partners, more = np.zeros(len(self.n), dtype=np.int64), np.zeros(len(self.n), dtype=bool)
        held: list[tuple[np.ndarray, np.ndarray]] = []
        n_held, enough = 0, HELD_PAIRS
        parts = [((*pair, None) for pair in self._few())]
        parts += [
            self._many(int(begin), int(size), all_of_asked)
            for begin, size in zip(self.begins, self.sizes, strict=True)
            if size > MANY_SETS
        ]
        for part in parts:
            for later, earlier, left in part:
                if left is not None:
                    more[left] = True
                if all_of_asked:
                    chosen = self.asked[later]
                    yield self._batch(later[chosen], earlier[chosen], np.zeros(int(chosen.sum()), dtype=bool))
                    continue
                if len(later):
                    np.add.at(partners, later, 1)
                    held.append((later, earlier))
                    n_held += len(later)
                if n_held > enough:
                    held = [self._earliest(held)]
                    n_held = len(held[0][0])
                    enough = max(HELD_PAIRS, 2 * n_held)
        if held:
            later, earlier = self._earliest(held)
            yield self._batch(later, earlier, (partners[later] > PARTNERS) | more[later])

    def _earliest(self, held: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
        """Of the pairs of each later set the ``PARTNERS`` with the earliest partner."""
        later, earlier = (np.concatenate(side) for side in zip(*held, strict=True))
        order = np.lexsort((self.set_id[earlier], self.line[earlier], self.order_id[earlier], later))
        later, earlier = later[order], earlier[order]
        starts = _starts(later) if len(later) else np.empty(0, dtype=np.int64)
        place = np.arange(len(later)) - np.repeat(starts, np.diff(np.r_[starts, len(later)]))
        return later[place < PARTNERS], earlier[place < PARTNERS]

    def _batch(self, later: np.ndarray, earlier: np.ndarray, more: np.ndarray) -> pa.RecordBatch:
        return _record(PAIRS, self.key[later], self.set_id[later], self.set_id[earlier], more)


PAIRS = "key long, later long, earlier long, more boolean"
MET = f"{PAIRS}, order_id long, text_key long, line int, set_id long, is_first boolean, again boolean"


def _padded(batch: pa.RecordBatch) -> pa.RecordBatch:
    """The columns of ``MET``, null where the batch has none."""
    kinds = {"long": pa.int64(), "int": pa.int32(), "boolean": pa.bool_()}
    names = set(batch.schema.names)
    return _record(
        MET,
        *(
            batch.column(name) if name in names else pa.nulls(batch.num_rows, kinds[kind])
            for name, kind in (part.split() for part in MET.split(", "))
        ),
    )


def _line_rows(lines: np.ndarray) -> pa.RecordBatch:
    """All lines of some sets, which of them is the first of its set, and whether the line of an equal row of the table came before."""
    # In the order in which sets meet: by id and place, whichever of the texts of one id has the line.
    lines = lines[np.lexsort([lines[name] for name in ("text_key", "line", "order_id", "set_id")])]
    columns = {name: np.ascontiguousarray(lines[name]) for name in LINE.names}
    starts = _starts(columns["set_id"])
    of = np.repeat(starts, np.diff(np.r_[starts, len(lines)]))
    is_first = np.logical_and.reduce([columns[name] == columns[name][of] for name in ("order_id", "text_key", "line")])
    again = np.zeros(len(lines), dtype=bool)
    again[1:] = np.logical_and.reduce([column[1:] == column[:-1] for column in columns.values()])
    names = (*LINE.names, "is_first", "again")
    return pa.RecordBatch.from_arrays([pa.array(x) for x in (*columns.values(), is_first, again)], names=list(names))


def _met_in_buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def met(held: dict[int, list[bytes]]) -> Iterator[pa.RecordBatch]:
        lines = held.pop(LINE_KIND, None)
        if lines:
            yield _padded(_line_rows(np.frombuffer(b"".join(lines), dtype=LINE)))
        parts = [np.frombuffer(b"".join(rows), dtype=set_type(kind)) for kind, rows in held.items()]
        if parts:
            for pairs in Meeting([(part, np.ones(len(part), dtype=bool)) for part in parts]).pairs(False):
                yield _padded(pairs)

    held: dict[int, list[bytes]] = {}
    current = None
    for batch in batches:
        for bucket, kind, rows in zip(*(batch.column(name).to_pylist() for name in ("bucket", "kind", "rows")), strict=True):
            if bucket != current:
                yield from met(held)
                held, current = {}, bucket
            held.setdefault(kind, []).append(rows)
    yield from met(held)


def _met_again(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def met(rows: pa.Table) -> Iterator[pa.RecordBatch]:
        kinds, asked = rows.column("kind").to_numpy(), rows.column("asked").to_numpy()
        parts = []
        for kind in np.unique(kinds):
            chosen = kinds == kind
            data = b"".join(rows.column("rows").filter(pa.array(chosen)).to_pylist())
            parts.append((np.frombuffer(data, dtype=set_type(int(kind))), asked[chosen]))
        yield from Meeting(parts).pairs(True)

    held, n_held, enough = [], 0, MEETING_ROWS
    for batch in batches:
        held.append(batch)
        n_held += batch.num_rows
        if n_held < enough:
            continue
        rows = pa.Table.from_batches(held)
        key = rows.column("key").to_numpy()
        # The last word may go on in the next batch.
        cut = int(np.searchsorted(key, key[-1]))
        if cut:
            yield from met(rows.slice(0, cut))
        held, n_held = rows.slice(cut).to_batches(), len(key) - cut
        enough = max(MEETING_ROWS, 2 * n_held)
    if n_held:
        yield from met(pa.Table.from_batches(held))


def hot_words(sample: DataFrame, ranks: np.ndarray) -> tuple[Hot, int]:
    """Hot words, and the number of buckets, as a sample tells; it decides on the tasks and never on the result.

    There is at most one hot word for so many prefix rows, and only these come to the driver.
    """
    none = Hot(np.empty(0, dtype=np.uint64), np.empty(0, dtype=np.int64))
    met = staged(single_rows(sample, ranks, none).groupBy("key").agg(F.count(F.lit(1)).alias("met")), "sampled-words")
    rows = (met.agg(F.sum("met")).first()[0] or 0) * SAMPLE_SHARE
    blocks = F.ceil(F.col("met") * F.lit(SAMPLE_SHARE / HOT_SETS)).cast("long")
    hot = met.select("key", blocks.alias("blocks")).filter("blocks > 1").orderBy("key").collect()
    buckets = max(LEAST_BUCKETS, min(rows // BUCKET_ROWS, MANY_BUCKETS), rows // MOST_BUCKET_ROWS)
    return Hot(np.array([r[0] for r in hot], dtype=np.uint64), np.array([r[1] for r in hot], dtype=np.int64)), buckets


def sets_of(docs: DataFrame, lines: DataFrame, wanted: DataFrame) -> DataFrame:
    """set_id and its words as bytes, for the ids in ``wanted`` (unique), from their first lines."""
    places = (
        lines.filter("is_first")
        .join(wanted, F.col("set_id") == F.col("wanted"), "left_semi")
        .groupBy(F.col("order_id").alias("of_id"), F.col("text_key").alias("of_key"))
        .agg(F.collect_set("line").alias("lines"))
    )
    places = staged(places, "places")
    if wanted.count() <= BROADCAST_CLASSES:
        places = F.broadcast(places)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = []
            for text, numbers in zip(_texts(batch), batch.column("lines").to_pylist(), strict=True):
                split = text.split(b"\n")
                texts += [split[number] for number in numbers]
            for sets in _sets(_words(texts)):
                parts = np.split(sets.words, sets.starts[1:])
                yield _record("set_id long, words binary", sets.set_id, pa.array([part.tobytes() for part in parts], pa.binary()))

    every = docs.select(*_keyed(), "text").join(
        places, (F.col("order_id") == F.col("of_id")) & (F.col("text_key") == F.col("of_key"))
    )
    return every.select("text", "lines").mapInArrow(rows, "set_id long, words binary").dropDuplicates(["set_id"])


def _sets_match(x: bytes, y: bytes) -> bool:
    one, other = np.frombuffer(x, dtype=np.uint64), np.frombuffer(y, dtype=np.uint64)
    return overlap(one, other) >= least_overlap(len(one), len(other))


def _verified(docs: DataFrame, lines: DataFrame, pairs: DataFrame) -> DataFrame:
    """The later sets of the pairs that match."""

    @F.pandas_udf("boolean")
    def match(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series([_sets_match(x, y) for x, y in zip(a, b, strict=True)], dtype=bool)

    wanted = pairs.select(F.explode(F.array("later", "earlier")).alias("wanted")).distinct()
    sets = staged(sets_of(docs, lines, staged(wanted, "wanted")), "sets")
    later = sets.select(F.col("set_id").alias("later"), F.col("words").alias("later_words"))
    earlier = sets.select(F.col("set_id").alias("earlier"), F.col("words").alias("earlier_words"))
    return (
        pairs.join(later, "later").join(earlier, "earlier")
        .filter(match("later_words", "earlier_words"))
        .select("later")
        .distinct()
    )


def later_sets(docs: DataFrame, met: DataFrame, ranks: np.ndarray, hot: Hot) -> DataFrame:
    """Ids of the sets that match a set with an earlier first line."""
    lines, met = met.filter("set_id IS NOT NULL"), met.filter("later IS NOT NULL")
    pairs = staged(met.select("later", "earlier").distinct(), "pairs")
    found = staged(_verified(docs, lines, pairs), "later-sets")
    left = staged(
        met.filter("more").select(F.col("later").alias("open"), F.col("key").alias("open_key")).distinct()
        .join(found.withColumnRenamed("later", "known"), F.col("open") == F.col("known"), "left_anti"),
        "open-sets",
    )
    n_left = left.count()
    if not n_left:
        return found
    # Only the words at which these sets have met too few of the others are looked at again.
    keys, sets = left.select("open_key").distinct(), left.select("open").distinct()
    if n_left <= BROADCAST_CLASSES:
        keys, sets = F.broadcast(keys), F.broadcast(sets)
    asked = (
        single_rows(docs, ranks, hot).join(keys, F.col("key") == F.col("open_key"), "left_semi")
        .join(sets, F.col("set_id") == F.col("open"), "left")
        .withColumn("asked", F.col("open").isNotNull())
        .drop("open", "set_id")
    )
    again = asked.repartition("key").sortWithinPartitions("key").mapInArrow(_met_again, PAIRS)
    rest = again.select("later", "earlier").distinct().join(
        pairs.select(F.col("later").alias("l"), F.col("earlier").alias("e")),
        (F.col("later") == F.col("l")) & (F.col("earlier") == F.col("e")),
        "left_anti",
    )
    return found.unionByName(staged(_verified(docs, lines, staged(rest, "open-pairs")), "later-sets-again"))


def removed_lines(docs: DataFrame) -> DataFrame:
    """order_id, text_key, the lines that the document loses and those that equal rows after it lose, null if there are none.

    Only where there are any.
    """
    docs = docs.select("doc_id", "text")
    small_batches(docs.sparkSession)
    sample = staged(docs.filter(F.pmod(F.xxhash64("doc_id", "text"), F.lit(SAMPLE_SHARE)) == 0).select(*docs.columns), "sample")
    ranks = slot_ranks(sample)
    hot, buckets = hot_words(sample, ranks)
    together = packed_rows(docs, ranks, hot, buckets).repartition("bucket").sortWithinPartitions("bucket")
    met = staged(together.mapInArrow(_met_in_buckets, MET), "met")
    goes = later_sets(docs, met, ranks, hot).select(F.col("later").alias("goes")).distinct()
    matched = F.expr("NOT is_first OR goes IS NOT NULL")
    of_copies = F.collect_set(F.when(F.col("again"), F.col("line")))
    return (
        met.filter("set_id IS NOT NULL")
        .join(goes, F.col("set_id") == F.col("goes"), "left")
        .filter(matched | F.col("again"))
        .groupBy("order_id", "text_key")
        .agg(F.collect_set(F.when(matched, F.col("line"))).alias("lines"), F.when(F.size(of_copies) > 0, of_copies).alias("of_copies"))
    )


def told_apart(copies: DataFrame) -> DataFrame:
    """Rows that share id and text with others: ``lines`` of all but the first of them are those of copies.

    The first is found by an aggregate, so that a row of very many copies is no single task's work.
    """
    numbered = staged(copies.drop("text").withColumn("number", F.monotonically_increasing_id()), "copies")
    firsts = numbered.groupBy("order_id", "text_key").agg(F.min("number").alias("first")).select("first")
    lines = F.when(F.col("first").isNull(), F.col("of_copies")).otherwise(F.col("lines"))
    met = numbered.join(firsts, F.col("number") == F.col("first"), "left")
    return met.withColumns({"lines": lines, "text": F.col("doc.text")}).drop("number", "first")


def dedup(docs: DataFrame) -> DataFrame:
    """``doc`` (all columns as a struct) and ``found``: the text that stays, lines, and how many of them went."""

    @F.pandas_udf("string")
    def without(parts: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for texts, gone in parts:
            rows = []
            for text, numbers in zip(texts, gone, strict=True):
                out = set() if numbers is None else set(numbers)
                rows.append(text and "\n".join(x for k, x in enumerate(text.split("\n")) if k not in out))
            yield pd.Series(rows, dtype=object)

    gone = staged(removed_lines(docs), "gone")
    n_gone = F.size("lines") + F.when(F.col("of_copies").isNotNull(), F.size("of_copies")).otherwise(0)
    size, n_copied = gone.agg(F.coalesce(F.sum(n_gone), F.lit(0)), F.count("of_copies")).first()
    gone = gone.withColumnsRenamed({"order_id": "of_id", "text_key": "of_key"})
    if size <= BROADCAST_LINES:
        gone = F.broadcast(gone)
    rows = docs.select(as_row(docs), "text", *_keyed())
    met = rows.join(gone, (F.col("order_id") == F.col("of_id")) & (F.col("text_key") == F.col("of_key")), "left")
    if n_copied:
        met = met.filter("of_copies IS NULL").unionByName(told_apart(met.filter("of_copies IS NOT NULL")))
    text, touched = F.col("text"), F.col("lines").isNotNull()
    # Only texts that lose lines go to Python workers.
    shorter = met.withColumn("shorter", without(F.when(touched, text), F.col("lines")))
    breaks = F.length(text) - F.length(F.replace(text, F.lit("\n"), F.lit("")))
    n_lines = F.when(F.length(text) > 0, breaks + 1).otherwise(0).cast("int")
    n_removed = F.when(touched, F.size("lines")).otherwise(0).cast("int")
    kept = F.when(touched, F.col("shorter")).otherwise(text)
    return shorter.select("doc", F.struct(kept.alias("text"), n_lines.alias("n_lines"), n_removed.alias("n_removed")).alias("found"))
