"""WARC archives: a writer with deduplicated payloads, and a reader that salvages damaged files.

Writer: every task writes archives of its own, each record a gzip member, under names that no other attempt of a task
has; a manifest lists those of the attempts that ended well, and only those are read. A page whose payload equals that of a page
with a smaller id becomes a ``revisit`` of it, without the payload.

Reader: a record counts if its version line and header fields
parse, its block has the stated length and the block's digest agrees; without a digest its member must inflate with
a right checksum. A member may hold any number of records. Where a check fails, the
reader searches for the next version line within the member, or else for the next gzip member, goes on there, and logs the bytes
between as quarantined. Files are read in pieces of ``PIECE`` bytes and inflated in steps of ``STEP``; what is held
is two records at most.

Rules for odd input: null html is an empty payload; a null page id is written as an empty one and sorts last, so a page without
an id revisits one with; rows that share the smallest id of a payload are all responses; an empty table writes no archive;
other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from typing import NamedTuple

import pandas as pd
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import scratch_folder, staged

#: A task goes on to a new archive when one has grown to this size.
ARCHIVE_BYTES = 256 << 20
PIECE = 1 << 20
#: Payloads that repeat are looked up by broadcast up to this number of them, 64 MB.
BROADCAST_PAYLOADS = 500_000
LEVEL = 3
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
LONGEST_HEADER = 1 << 20
# Fields that every record must have.
REQUIRED = ("warc-type", "warc-record-id", "warc-date", "content-length")

MAGIC = b"\x1f\x8b\x08"
VERSION_MARK = b"WARC/1."
#: Bytes that are inflated at once, and the most that deflate makes of one byte.
STEP, DEFLATE_RATIO = 1 << 16, 1040
VERSION = re.compile(rb"WARC/1\.[01]\r\n")
BREAK = b"\r\n\r\n"

RECORD = (
    "archive string, offset long, length long, record_type string, record_id string, target_uri string, "
    "refers_to string, payload_digest string, payload_bytes long, payload binary, gap_end long, reason string"
)


def base32_sha1(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def page_urn(page_id) -> str:
    return f"<urn:page:{'' if page_id is None else int(page_id)}>"


def record_bytes(page_id, url: str | None, payload: bytes, first_id, revisit: bool) -> bytes:
    """One record; ``first_id`` is the page that a revisit refers to."""
    http = [b"HTTP/1.1 200 OK", b"Content-Type: text/html; charset=utf-8", f"Content-Length: {len(payload)}".encode()]
    block = b"\r\n".join(http) + BREAK + (b"" if revisit else payload)
    fields = [
        ("WARC-Type", "revisit" if revisit else "response"),
        ("WARC-Record-ID", page_urn(page_id)),
        ("WARC-Date", DATE),
        ("WARC-Target-URI", re.sub(r"[\r\n]", " ", url or "")),
        ("Content-Type", "application/http;msgtype=response"),
        ("WARC-Payload-Digest", f"sha1:{base32_sha1(payload)}"),
        ("WARC-Block-Digest", f"sha1:{base32_sha1(block)}"),
    ]
    if revisit:
        fields += [("WARC-Profile", PROFILE), ("WARC-Refers-To", page_urn(first_id))]
    fields.append(("Content-Length", str(len(block))))
    head = "WARC/1.1\r\n" + "".join(f"{name}: {value}\r\n" for name, value in fields) + "\r\n"
    return head.encode("utf-8", "surrogatepass") + block + BREAK


def member(record: bytes) -> bytes:
    packed = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
    return packed.compress(record) + packed.flush()


def _place(uri: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(uri if "://" in uri or uri.startswith("/") else uri.replace("file:", "", 1))


def _write_archives(folder: str, archive_bytes: int):
    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        out, name, size, records = None, "", 0, 0
        for batch in batches:
            for page_id, url, html, first, revisit in zip(
                batch["page_id"], batch["url"], batch["html"], batch["first_id"], batch["revisit"], strict=True
            ):
                if out is None:
                    files, at = _place(folder)
                    name, size, records = f"{uuid.uuid4().hex}.warc.gz", 0, 0
                    out = files.open_output_stream(f"{at}/{name}", compression=None)
                payload = (html or "").encode("utf-8", "surrogatepass")
                ids = [None if pd.isna(x) else x for x in (page_id, first)]
                packed = member(record_bytes(ids[0], url, payload, ids[1], bool(revisit)))
                out.write(packed)
                size, records = size + len(packed), records + 1
                if size >= archive_bytes:
                    out.close()
                    out = None
                    yield pd.DataFrame({"archive": [f"{folder}/{name}"], "bytes": [size], "records": [records]})
        if out is not None:
            out.close()
            yield pd.DataFrame({"archive": [f"{folder}/{name}"], "bytes": [size], "records": [records]})

    return write


def write_pages(pages: DataFrame, folder: str, smallest: int = 0, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Archives of page_id, url and html in ``folder``; gives the manifest: archive, bytes, records.

    Payloads under ``smallest`` bytes are always responses. Only digests are grouped; pages never move, unless
    more payloads repeat than may be broadcast.
    """
    html = F.coalesce(F.col("html"), F.lit(""))
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"), "url", html.alias("html"), F.sha1(html.cast("binary")).alias("digest")
    )
    repeated = staged(
        rows.filter(F.octet_length("html") >= smallest)
        .groupBy("digest")
        .agg(F.count(F.lit(1)).alias("n"), F.min("page_id").alias("first_id"))
        .filter("n > 1")
        .select(F.col("digest").alias("repeated"), "first_id"),
        "repeated-payloads",
    )
    if repeated.count() <= BROADCAST_PAYLOADS:
        repeated = F.broadcast(repeated)
    marked = rows.join(repeated, F.col("digest") == F.col("repeated"), "left").select(
        "page_id",
        "url",
        "html",
        "first_id",
        (F.col("repeated").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first_id"))).alias("revisit"),
    )
    written = marked.mapInPandas(_write_archives(folder, archive_bytes), "archive string, bytes long, records long")
    return staged(written, "manifest")


class Source:
    """Bytes of a file by position, read in pieces."""

    def __init__(self, file):
        self.file, self.size = file, file.size()

    def at(self, start: int, length: int) -> bytes:
        if start >= self.size:
            return b""
        self.file.seek(start)
        return self.file.read(min(length, self.size - start))

    def find(self, pattern: bytes, start: int) -> int:
        """The first place from ``start`` on where ``pattern`` stands, or -1."""
        while start < self.size:
            piece = self.at(start, PIECE)
            found = piece.find(pattern)
            if found >= 0:
                return start + found
            if start + len(piece) >= self.size:
                break
            start += len(piece) - len(pattern) + 1
        return -1


class Damaged(Exception):
    pass


class Found(NamedTuple):
    end: int
    fields: dict[str, str]
    block: bytes


def _parsed(record: bytes) -> tuple[dict[str, str], int, int]:
    """Header fields, start of the block and its stated length."""
    if not VERSION.match(record):
        raise Damaged("no version line")
    close = record.find(BREAK)
    if close < 0:
        raise Damaged("no end of header")
    fields = {}
    for line in record[:close].split(b"\r\n")[1:]:
        name, colon, value = line.partition(b":")
        if not colon:
            raise Damaged("bad header line")
        fields[name.strip().decode("utf-8", "replace").lower()] = value.strip().decode("utf-8", "replace")
    if missing := [name for name in REQUIRED if not fields.get(name)]:
        raise Damaged(f"no {missing[0]}")
    if not re.fullmatch(r"[0-9]+", fields["content-length"]):
        raise Damaged("bad length")
    return fields, close + len(BREAK), int(fields["content-length"])


def _checked(fields: dict[str, str], block: bytes) -> None:
    stated = fields.get("warc-block-digest", "")
    if stated.startswith("sha1:") and stated[5:] != base32_sha1(block):
        raise Damaged("block digest differs")


def _after_gzip_header(source: Source, start: int) -> int | None:
    """Where the compressed bytes of a gzip member begin, null if its header is cut off."""
    head = source.at(start, PIECE if PIECE > 1024 else 1024)
    at, flags = 10, head[3] if len(head) > 3 else 0
    if flags & 4:
        at += 2 + int.from_bytes(head[at : at + 2], "little")
    for flag in (8, 16):
        if flags & flag:
            at = head.find(b"\0", at) + 1 or len(head) + 1
    at += 2 if flags & 2 else 0
    return start + at if at <= len(head) else None


class Inflated:
    """What a gzip member holds, inflated bit by bit from a file; bytes that were looked at can be dropped.

    The checksum is compared here, so that what comes before a damage is had.
    """

    def __init__(self, source: Source, start: int):
        self.source, self.at = source, _after_gzip_header(source, start)
        self.inflater, self.waiting = zlib.decompressobj(-15), b""
        self.held, self.checksum, self.size = bytearray(), 0, 0
        self.damage, self.ended = (None, False) if self.at else ("cut off member", True)

    def fill(self, size: int) -> bool:
        """Hold so many bytes, if the member has them."""
        while len(self.held) < size and not self.ended:
            if not self.waiting:
                self.waiting = self.source.at(self.at, min(PIECE, STEP))
                self.at += len(self.waiting)
            if not self.waiting:
                self.damage, self.ended = "cut off member", True
                break
            before = self.inflater.copy()
            try:
                self._take(self.inflater.decompress(self.waiting, STEP))
            except zlib.error:
                self._crawl(before)
                break
            self.waiting = self.inflater.unconsumed_tail
            if self.inflater.eof:
                self._end()
        return len(self.held) >= size

    def _take(self, data: bytes) -> None:
        self.held += data
        self.checksum, self.size = zlib.crc32(data, self.checksum), self.size + len(data)

    def _crawl(self, inflater) -> None:
        """The last bytes before a damage."""
        try:
            while self.waiting:
                data = inflater.decompress(self.waiting, 1)
                self._take(data)
                self.waiting = inflater.unconsumed_tail
        except zlib.error:
            pass
        self.damage, self.ended = "bad member", True

    def _end(self) -> None:
        end = self.at - len(self.inflater.unused_data)
        trailer = self.source.at(end, 8)
        self.at, self.ended = end + 8, True
        if len(trailer) < 8:
            self.damage = "cut off member"
        elif trailer != self.checksum.to_bytes(4, "little") + (self.size & 0xFFFFFFFF).to_bytes(4, "little"):
            self.damage = "bad member"

    def drop(self, size: int) -> None:
        del self.held[:size]

    def skip_to_version(self) -> bool:
        """Drop all before the next version line, if there is one."""
        while True:
            found = self.held.find(VERSION_MARK)
            if found >= 0:
                self.drop(found)
                return True
            self.drop(max(0, len(self.held) - len(VERSION_MARK) + 1))
            if not self.fill(len(self.held) + STEP) and self.held.find(VERSION_MARK) < 0:
                return False


def _next_in(member: Inflated, longest: int) -> Found:
    """The record with which the rest of a member begins; it is dropped if it is good."""
    size = 12
    while member.fill(size) or member.held:
        if not VERSION.match(member.held[:12]):
            raise Damaged("no version line")
        if BREAK in member.held:
            break
        if member.ended or size > LONGEST_HEADER:
            raise Damaged(member.damage or "no end of header")
        size = max(STEP, 2 * size)
    fields, begin, length = _parsed(bytes(member.held[: member.held.find(BREAK) + len(BREAK)]))
    if length > longest:
        raise Damaged("length differs")
    end = begin + length
    if not member.fill(end + len(BREAK)) or member.held[end : end + len(BREAK)] != BREAK:
        raise Damaged(member.damage or "length differs")
    block = bytes(member.held[begin:end])
    _checked(fields, block)
    member.drop(end + len(BREAK))
    return Found(0, fields, block)


def _sound(source: Source, start: int) -> bool:
    """Whether a member inflates to its end with a right checksum; nothing of it is held."""
    member = Inflated(source, start)
    while member.fill(1):
        member.drop(len(member.held))
    return member.damage is None


def member_records(source: Source, start: int) -> Iterator[Found | Damaged]:
    """The records of the member at ``start``, and what was wrong between them; ends with the place after it, as ``Found``.

    A member may hold any number of records. After a failed check the search goes on for the next version line within it.
    Of a member that does not inflate with a right checksum, records count that carry a digest of their block.
    """
    member, good = Inflated(source, start), None
    if source.at(start, len(MAGIC)) != MAGIC:
        yield Damaged("no member")
        return
    # No block is longer than what the rest of the file can inflate to.
    longest = (source.size - start) * DEFLATE_RATIO
    while member.fill(1):
        try:
            found = _next_in(member, longest)
        except Damaged as damage:
            yield damage
            if not member.fill(1):
                break
            member.drop(1)
            if not member.skip_to_version():
                break
            continue
        if not found.fields.get("warc-block-digest"):
            if good is None:
                good = member.damage is None if member.ended else _sound(source, start)
            if not good:
                yield Damaged("bad member")
                continue
        yield found
    if member.damage:
        yield Damaged(member.damage)
    else:
        yield Found(member.at, {}, b"")


def plain_record(source: Source, start: int) -> Found:
    """The record whose version line is at ``start``."""
    head = source.at(start, 4096)
    while BREAK not in head and len(head) < LONGEST_HEADER and start + len(head) < source.size:
        head += source.at(start + len(head), 4096)
    fields, begin, length = _parsed(head)
    end = start + begin + length
    if source.at(end, len(BREAK)) != BREAK:
        raise Damaged("length differs")
    block = source.at(start + begin, length)
    _checked(fields, block)
    return Found(end + len(BREAK), fields, block)


def salvage(source: Source, zipped: bool) -> Iterator[tuple[int, int, Found | None, str | None]]:
    """(start, end, record, None) of every good record and (start, end, None, reason) of every gap, in order.

    Of a member with several records the last one has its length, and so has the gap if anything in it was wrong; the others
    have none.
    """
    return _salvage_members(source) if zipped else _salvage_plain(source)


def _salvage_plain(source: Source) -> Iterator[tuple[int, int, Found | None, str | None]]:
    at, gap, reason = 0, None, None
    while 0 <= at < source.size:
        try:
            found = plain_record(source, at)
        except Damaged as damage:
            if gap is None:
                gap, reason = at, str(damage)
            at = source.find(VERSION_MARK, at + 1)
            continue
        if gap is not None:
            yield gap, at, None, reason
            gap = None
        yield at, found.end, found, None
        at = found.end
    if gap is not None:
        yield gap, source.size, None, reason


def _salvage_members(source: Source) -> Iterator[tuple[int, int, Found | None, str | None]]:
    at, gap, reason = 0, None, None
    while 0 <= at < source.size:
        end, held, problems = None, None, []
        for thing in member_records(source, at):
            if isinstance(thing, Damaged):
                problems.append(str(thing))
            elif not thing.fields:
                end = thing.end
            else:
                if gap is not None:
                    yield gap, at, None, reason
                    gap = None
                if held is not None:
                    yield at, at, held, None
                # The last record of a sound member stands for its bytes, so one is held until it is known.
                held = thing
        sound = end is not None
        end = end if sound else source.find(MAGIC, at + 1)
        after = source.size if end < 0 else end
        if held is None:
            if gap is None:
                gap, reason = at, problems[0] if problems else "no record"
        elif problems:
            yield at, at, held, None
            yield at, after, None, problems[0]
        else:
            yield at, after, held, None
        at = end
    if gap is not None:
        yield gap, source.size, None, reason


def _read_archives(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    names = [field.split()[0] for field in RECORD.split(", ")]
    rows, held = [], 0
    for batch in batches:
        for archive in batch["archive"]:
            files, at = _place(archive)
            with files.open_input_file(at) as file:
                for start, end, found, reason in salvage(Source(file), archive.endswith(".gz")):
                    if found is None:
                        rows.append((archive, start, end - start, "quarantined", *[None] * 6, end, reason))
                    else:
                        fields, payload = found.fields, None
                        head, _, body = found.block.partition(BREAK)
                        stated = re.search(rb"(?i)\r\ncontent-length: *([0-9]+)", head)
                        n_bytes = int(stated[1]) if stated else len(body)
                        if fields.get("warc-type") != "revisit":
                            payload, n_bytes = body, len(body)
                        digest = base32_sha1(body) if payload is not None else fields.get("warc-payload-digest", "").removeprefix("sha1:")
                        rows.append(
                            (archive, start, end - start, fields.get("warc-type"), fields.get("warc-record-id"),
                             fields.get("warc-target-uri"), fields.get("warc-refers-to"), digest, n_bytes, payload, None, None)
                        )
                        held += len(found.block)
                    if held > 16 << 20 or len(rows) >= 5000:
                        yield pd.DataFrame(rows, columns=names)
                        rows, held = [], 0
    if rows:
        yield pd.DataFrame(rows, columns=names)


def read_archives(archives: DataFrame, parts: int | None = None) -> DataFrame:
    """All records of the archives (column ``archive``), and a row of type ``quarantined`` for every byte gap."""
    paths = archives.select("archive")
    if parts:
        paths = paths.repartition(parts)
    return paths.mapInPandas(_read_archives, RECORD)


def page_of(urn: Column) -> Column:
    return F.regexp_extract(urn, "^<urn:page:(-?[0-9]*)>$", 1).try_cast("long")


def round_trip(spark: SparkSession, pages: DataFrame, smallest: int = 0) -> DataFrame:
    """Writes ``pages`` and reads the archives back: a row per page from the records' own fields."""
    folder = scratch_folder(spark, "warc")
    manifest = write_pages(pages, folder, smallest)
    records = read_archives(manifest, max(1, manifest.count()))
    revisit = F.col("record_type") == "revisit"
    return records.filter("record_type <> 'quarantined'").select(
        page_of(F.col("record_id")).alias("page_id"),
        "payload_bytes",
        "payload_digest",
        "record_type",
        F.when(revisit, page_of(F.col("refers_to"))).alias("refers_to"),
    )
