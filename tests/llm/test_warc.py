from __future__ import annotations

import io
import random
import re

import pytest
from pyspark.sql import functions as F

from tidemark.llm import warc
from tidemark.llm.common import scratch_folder

PAGES = [
    (3, "http://a/3", "<p>same</p>"),
    (1, "http://a/1", "<p>same</p>"),
    (2, "http://a/2", None),
    (5, None, ""),
    (4, "http://a/4\r\nWARC-Type: evil", "WARC/1.1\r\nContent-Length: 5\r\n\r\nhello\r\n\r\n\x1f\x8b\x08"),
    (6, "http://ü/6", "é" * 70_000),
    (1, "http://a/1", "<p>same</p>"),
    (None, "http://a/none", "<p>same</p>"),
    (None, None, None),
    (7, "http://a/7", "x" * 3_000_000),
]


@pytest.fixture(scope="module")
def pages(spark):
    extra = [(*row, "clash", 9) for row in PAGES]
    return spark.createDataFrame(extra, "page_id long, url string, html string, digest string, first_id int")


def test_round_trip(spark, pages):
    rows = sorted(map(tuple, warc.round_trip(spark, pages).collect()), key=str)
    least = {}
    for page_id, _, html in PAGES:
        if page_id is not None:
            least[html or ""] = min(least.get(html or "", page_id), page_id)
    want = []
    for page_id, _, html in PAGES:
        data, first = (html or "").encode(), least.get(html or "")
        kind = "response" if page_id == first else "revisit"
        want.append((page_id, len(data), warc.base32_sha1(data), kind, first if kind == "revisit" else None))
    assert rows == sorted(want, key=str)
    assert warc.round_trip(spark, pages.limit(0)).collect() == []


def test_small_payloads_are_responses(spark, pages):
    rows = warc.round_trip(spark, pages, smallest=100).collect()
    assert {r.record_type for r in rows} == {"response"}


def test_texts_come_back_and_archives_rotate(spark, pages):
    manifest = warc.write_pages(pages.coalesce(1), scratch_folder(spark, "t"), archive_bytes=600).collect()
    assert len(manifest) > 2 and sum(r.records for r in manifest) == len(PAGES)
    back = warc.read_archives(spark.createDataFrame(manifest)).collect()
    texts = {r.payload.decode() for r in back if r.record_type == "response"}
    assert texts == {html or "" for _, _, html in PAGES}
    assert not [r for r in back if r.record_type == "quarantined"]


class File(io.BytesIO):
    def size(self):
        return len(self.getvalue())


def records(n):
    r = random.Random(1)
    return [
        warc.record_bytes(k, f"http://a/{k}", bytes(r.randrange(256) for _ in range(r.randrange(4000))), None, False)
        for k in range(n)
    ]


def salvaged(data: bytes, zipped: bool):
    found = list(warc.salvage(warc.Source(File(data)), zipped))
    # Records and gaps cover the file, in order, without a hole.
    assert [f[0] for f in found[1:]] == [f[1] for f in found[:-1]]
    assert not found or (found[0][0], found[-1][1]) == (0, len(data))
    urns = [re.fullmatch(r"<urn:page:([0-9]+)>", f[2].fields["warc-record-id"]) for f in found if f[2]]
    return [int(urn[1]) for urn in urns if urn], [f for f in found if f[2] is None]


@pytest.mark.parametrize("zipped", [True, False])
@pytest.mark.parametrize("piece", [97, 1 << 20])
def test_salvage_recovers_all_other_records(zipped, piece, monkeypatch):
    monkeypatch.setattr(warc, "PIECE", piece)
    parts = [warc.member(x) if zipped else x for x in records(12)]
    whole = b"".join(parts)
    starts = [sum(map(len, parts[:k])) for k in range(13)]
    assert salvaged(whole, zipped) == (list(range(12)), [])
    r = random.Random(2)
    for _ in range(40):
        hit = r.randrange(12)
        at = r.randrange(starts[hit], starts[hit + 1])
        damage = bytearray(whole)
        kind = r.choice(["flip", "cut", "insert"])
        if kind == "flip":
            damage[at] ^= 0x55
        elif kind == "cut":
            del damage[at : min(at + 30, starts[hit + 1])]
        else:
            damage[at:at] = b"\x00junk\xff" * 5
        ids, gaps = salvaged(bytes(damage), zipped)
        # A flipped bit in a header may leave a good record with another address; no other record may be lost.
        assert set(range(12)) - {hit} <= set(ids)
        assert gaps or hit in ids or kind == "flip"


def test_members_of_many_records():
    parts = records(12)
    assert salvaged(warc.member(b"".join(parts)), True) == (list(range(12)), [])
    several = warc.member(b"".join(parts[:5])) + warc.member(parts[5]) + warc.member(b"".join(parts[6:]))
    assert salvaged(several, True) == (list(range(12)), [])


@pytest.mark.parametrize("piece", [97, 1 << 20])
def test_damage_within_a_member_of_many_records(piece, monkeypatch):
    monkeypatch.setattr(warc, "PIECE", piece)
    monkeypatch.setattr(warc, "STEP", 1 + piece // 2)
    r = random.Random(4)
    parts = records(9)
    for _ in range(30):
        hit = r.randrange(9)
        broken = bytearray(parts[hit])
        at = r.randrange(len(broken))
        if r.random() < 0.5:
            broken[at] ^= 0x41
        else:
            del broken[at : at + 20]
        data = warc.member(b"".join([*parts[:hit], bytes(broken), *parts[hit + 1 :]])) + warc.member(parts[0])
        ids, gaps = salvaged(data, True)
        assert set(range(9)) - {hit} <= set(ids) and ids.count(0) >= 1
        assert gaps or hit in ids


def test_what_comes_before_the_damage_of_a_member_is_had():
    parts = records(9)
    whole = warc.member(b"".join(parts))
    ids, gaps = salvaged(whole[: len(whole) * 2 // 3], True)
    assert ids == list(range(len(ids))) and 4 <= len(ids) <= 7 and gaps[-1][3] == "cut off member"
    ids, gaps = salvaged(whole[:-6] + b"\0" * 6 + warc.member(parts[0]), True)
    # The checksum is wrong, but every block has its own.
    assert ids == [*range(9), 0] and len(gaps) == 1
    bare = [re.sub(rb"WARC-Block-Digest: [^\r]*\r\n", b"", part) for part in parts]
    packed = warc.member(b"".join(bare))
    assert salvaged(packed, True) == (list(range(9)), [])
    ids, gaps = salvaged(packed[:-6] + b"\0" * 6 + warc.member(parts[0]), True)
    assert ids == [0] and gaps[0][3] == "bad member"


def test_a_large_member_is_never_held_whole():
    import tracemalloc

    bomb = warc.member(b"WARC/1.1\r\nContent-Length: 99999999999\r\n\r\n" + b"x" * 10 + b"\0" * (200 << 20))
    many = warc.member(b"".join(records(3) * 2000))
    tracemalloc.start()
    assert salvaged(bomb, True)[0] == []
    assert len(salvaged(many, True)[0]) == 6000
    assert tracemalloc.get_traced_memory()[1] < 100 << 20
    tracemalloc.stop()


def test_salvage_of_cut_off_and_foreign_files():
    parts = [warc.member(x) for x in records(3)]
    ids, gaps = salvaged(b"".join(parts)[:-60], True)
    assert ids == [0, 1] and gaps[0][3] == "cut off member"
    # Only the checksum of the member is cut off; the block has a digest of its own.
    ids, gaps = salvaged(b"".join(parts)[:-7], True)
    assert ids == [0, 1, 2] and gaps[0][3] == "cut off member"
    ids, gaps = salvaged(b"no archive at all" * 100, True)
    assert ids == [] and len(gaps) == 1
    assert salvaged(b"", False) == ([], [])
    assert salvaged(b"\n\n" + records(1)[0], False)[0] == [0]


def test_gaps_are_logged_with_their_archive(spark):
    folder = scratch_folder(spark, "damaged")
    path = folder.removeprefix("file://").removeprefix("file:")
    data = b"".join(map(warc.member, records(5)))
    with open(f"{path}/a.warc.gz", "wb") as out:
        out.write(data[:50] + b"????" + data[54:])
    archives = spark.createDataFrame([(f"{path}/a.warc.gz",)], "archive string")
    rows = warc.read_archives(archives).orderBy("offset").collect()
    assert [r.record_type for r in rows] == ["quarantined"] + ["response"] * 4
    assert rows[0].gap_end == rows[1].offset and rows[0].reason
    assert warc.read_archives(archives).filter(F.col("record_type") == "response").count() == 4
