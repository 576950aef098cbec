"""Packing of documents into sequences by Karmarkar-Karp multiway differencing.

A text becomes token ids and an end id. What fills whole sequences is cut off first. The remainders are packed in the task
that made them, in groups of about ``GROUP_WINDOWS`` sequences: every item starts as a partial partition of its
own, all windows but one empty; the two partial partitions with the largest imbalance are merged, the fullest window of one with the emptiest
of the other, until one partition is left, whose windows are nearly equal. The number of windows is that of the full
sequences in the group; as this exceeds the capacity, the last group of a task raises it by one. What is
over the capacity is cut off and tops up windows with room, so a window costs one cut at most; what an
earlier group has left over joins the next one. So a task leaves less than one sequence of padding.

Nothing is shuffled and no task needs another's result, so a lost executor costs its own tasks only, and no key can be
hot. A task holds the ids of one batch of documents and of one group.

Rules for odd input: a null text is an empty one, which is its end id only; null and repeated ids are documents like others;
a text of any length is cut as above, its ids are held at once; an empty table gives an empty
result; other columns than ``doc_id`` and ``text`` are not read.
"""

from __future__ import annotations

import heapq
import re
import zlib
from array import array
from collections.abc import Iterator, Sequence
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tidemark.llm.common import small_batches

CAPACITY = 4096
#: Sequences that are packed together.
GROUP_WINDOWS = 128
#: Remainders under this many tokens are bundled into items of at least four times as many.
SMALL = 64
#: Words whose ids a Python worker remembers, twice: those of late, and as many before them.
CACHED_WORDS = 300_000
#: Bytes of a text that are split into words at once.
SEGMENT = 1 << 20
ID_BYTES = 4
SCHEMA = "doc_id long, start long, length long, ids binary, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
_FIELDS = pa.schema(
    [pa.field(name, pa.binary() if name == "ids" else pa.int64()) for name in re.findall(r"(\w+) \w+", SCHEMA)]
)
#: Letters that are one character in any normal form, and have a lower case of one letter.
_LETTERS = re.compile("[a-zÀ-ÖØ-öø-ÿ]+")
_MARKS = b".,;:!?"
#: Byte-level vocabularies spell a printable byte as the character of its code, and the others, in order, from 256 on.
_PRINTABLE = [*range(33, 127), *range(161, 173), *range(174, 256)]
_BYTE_LETTERS = {b: chr(b) for b in _PRINTABLE} | {
    b: chr(256 + i) for i, b in enumerate(b for b in range(256) if b not in _PRINTABLE)
}

#: (document, start, length): documents are numbered within the task.
Piece = tuple[int, int, int]


class WordIds(dict):
    """Packed ids of the words between white space, each made once.

    This holds for vocabularies like that of ``word_bpe_49k.json``: byte-level BPE over lower-cased runs of letters, white
    space dropped. A word of plain letters is one such run and goes straight to the vocabulary's BPE model; a word of
    them and a mark is these two; any other goes through the whole tokenizer.
    """

    def __init__(self, path: str):
        super().__init__()
        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.earlier: dict[bytes, bytes] = {}

    def __missing__(self, word: bytes) -> bytes:
        ids = self.earlier.get(word)
        if ids is None:
            if word.isalpha():
                ids = self._of_run(word.lower().decode("ascii"))
            elif word[-1] in _MARKS and _LETTERS.fullmatch(word[:-1].decode("utf-8", "replace")):
                ids = self[word[:-1]] + self[word[-1:]]
            elif _LETTERS.fullmatch(text := word.decode("utf-8", "replace")):
                ids = self._of_run("".join(map(_BYTE_LETTERS.__getitem__, text.lower().encode())))
            else:
                ids = _packed(self.tokenizer.encode(text, add_special_tokens=False).ids)
        if len(self) >= CACHED_WORDS:
            self.earlier = dict(self)
            self.clear()
        self[word] = ids
        return ids

    def _of_run(self, spelled: str) -> bytes:
        return _packed([token.id for token in self.model.tokenize(spelled)])

    def encode(self, text: str | None) -> bytes:
        """The packed ids of a text."""
        return b"".join(b"".join(map(self.__getitem__, words)) for words in _word_lists(text))


def _packed(ids: list[int]) -> bytes:
    return array("I", ids).tobytes()


@lru_cache(maxsize=1)
def word_ids(path: str) -> WordIds:
    """One for all tasks of a Python worker: reading a vocabulary takes longer than many a task."""
    return WordIds(path)


def _word_lists(text: str | None) -> Iterator[list[bytes]]:
    data = (text or "").encode("utf-8", "replace")
    if b"<|" not in data:  # else lower case might make a special token
        data = data.lower()
    start = 0
    while len(data) - start > SEGMENT:
        space = data.find(b" ", start + SEGMENT)
        if space < 0:
            break
        yield data[start:space].split()
        start = space
    yield data[start:].split()


def differencing(sizes: Sequence[int], windows: int) -> list[list[int]]:
    """The items of each window, by merging partial partitions with opposing imbalances."""
    n = len(sizes)
    if windows == 1 or n == 0:
        return [list(range(n)), *([] for _ in range(windows - 1))]
    left, right = np.full(n, -1), np.full(n, -1)
    made = 0  # merged windows are numbered from n on
    heap = []
    for i, size in enumerate(sizes):
        sums, held = np.zeros(windows, dtype=np.int64), np.full(windows, -1)
        sums[-1], held[-1] = size, i
        heap.append((-int(size), i, sums, held))
    heapq.heapify(heap)
    order = n
    while len(heap) > 1:
        _, _, sums_a, held_a = heapq.heappop(heap)
        _, _, sums_b, held_b = heapq.heappop(heap)
        # Sums ascend, so the fullest window of one meets the emptiest of the other.
        sums, other = sums_a + sums_b[::-1], held_b[::-1]
        held = np.maximum(held_a, other)
        both = np.flatnonzero((held_a >= 0) & (other >= 0))
        if len(both):
            new = slice(made, made + len(both))
            left[new], right[new] = held_a[both], other[both]
            held[both] = np.arange(n + made, n + made + len(both))
            made += len(both)
        by_size = np.argsort(sums, kind="stable")
        sums, held = sums[by_size], held[by_size]
        heapq.heappush(heap, (int(sums[0] - sums[-1]), order, sums, held))
        order += 1
    out = []
    for top in heap[0][3].tolist():
        items, open_ = [], [top] if top >= 0 else []
        while open_:
            node = open_.pop()
            if node < n:
                items.append(node)
            else:
                open_ += [int(left[node - n]), int(right[node - n])]
        out.append(items)
    return out


def _cut(pieces: list[Piece], length: int) -> tuple[list[Piece], list[Piece]]:
    """The first ``length`` tokens of some pieces, and the rest."""
    kept, rest = [], []
    for doc, start, n in pieces:
        here = min(n, length)
        if here:
            kept.append((doc, start, here))
        if n > here:
            rest.append((doc, start + here, n - here))
        length -= here
    return kept, rest


def tokens_in(pieces: list[Piece]) -> int:
    return sum(n for _, _, n in pieces)


def pack_group(items: list[list[Piece]], capacity: int, last: bool) -> tuple[list[list[Piece]], list[Piece]]:
    """The windows of a group, all of them full unless it is the ``last`` one, and the pieces left over."""
    sizes = [tokens_in(item) for item in items]
    windows, over = divmod(sum(sizes), capacity)
    if over and last:
        windows += 1
    if windows == 0:
        return [], [piece for item in items for piece in item]
    filled, rest = [], []
    for members in differencing(sizes, windows):
        kept, cut_off = _cut([piece for i in members for piece in items[i]], capacity)
        filled.append(kept)
        rest += cut_off
    for window in filled:
        if rest and (room := capacity - tokens_in(window)):
            more, rest = _cut(rest, room)
            window += more
    return [window for window in filled if window], rest


class Packer:
    """Packs the documents of one task as they come."""

    def __init__(self, first_sequence: int, end_id: int, capacity: int):
        self.sequence, self.end, self.capacity = first_sequence, _packed([end_id]), capacity
        self.documents: dict[int, tuple[int | None, bytes]] = {}
        self.items: list[list[Piece]] = []
        self.small: list[Piece] = []
        self.waiting = self.number = 0
        self.rows: list[tuple] = []

    def add(self, doc_id: int | None, ids: bytes) -> None:
        ids += self.end
        total, self.number = len(ids) // ID_BYTES, self.number + 1
        self.documents[self.number] = doc_id, ids
        whole = total - total % self.capacity
        for start in range(0, whole, self.capacity):
            self._emit([(self.number, start, self.capacity)])
        if whole == total:
            del self.documents[self.number]
            return
        self.waiting += total - whole
        piece = (self.number, whole, total - whole)
        if total - whole >= SMALL:
            self.items.append([piece])
        else:
            self.small.append(piece)
            if len(self.small) >= SMALL and tokens_in(self.small) >= 4 * SMALL:
                self.items.append(self.small)
                self.small = []
        if self.waiting >= GROUP_WINDOWS * self.capacity:
            self.pack(last=False)

    def pack(self, last: bool) -> None:
        items = [*self.items, self.small] if self.small else self.items
        windows, rest = pack_group(items, self.capacity, last)
        for window in windows:
            self._emit(window)
        self.items, self.small, self.waiting = [[piece] for piece in rest], [], tokens_in(rest)
        self.documents = {doc: self.documents[doc] for doc, _, _ in rest}

    def _emit(self, window: list[Piece]) -> None:
        offset = 0
        for doc, start, n in window:
            doc_id, ids = self.documents[doc]
            part = ids[start * ID_BYTES : (start + n) * ID_BYTES]
            self.rows.append((doc_id, start, n, part, zlib.crc32(part), len(ids) // ID_BYTES, self.sequence, offset))
            offset += n
        self.sequence += 1

    def batches(self) -> Iterator[pa.RecordBatch]:
        rows, self.rows = self.rows, []
        for first in range(0, len(rows), 2000):
            columns = zip(*rows[first : first + 2000], strict=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array(values, field.type) for values, field in zip(columns, _FIELDS, strict=True)], schema=_FIELDS
            )


def pack(docs: DataFrame, tokenizer_path: str, end_id: int, capacity: int = CAPACITY) -> DataFrame:
    """A row per piece: its document, place there, packed ids (little-endian unsigned 32-bit) and their CRC-32, the document's
    tokens, and its sequence and place there. Sequence ids are unique, with gaps."""
    small_batches(docs.sparkSession)

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = word_ids(tokenizer_path)
        packer = Packer(TaskContext.get().partitionId() << 33, end_id, capacity)
        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
                packer.add(doc_id, words.encode(text))
                if len(packer.rows) >= 2000:
                    yield from packer.batches()
        packer.pack(last=True)
        yield from packer.batches()

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(packed, SCHEMA)
