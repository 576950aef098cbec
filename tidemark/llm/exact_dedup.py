"""Exact dedup by two passes over a Bloom filter; DataFrame functions only.

Pass one hashes every text to two slots of a filter and marks the slots that were hit more than once.
Pass two tests every row: a row of which any slot was hit once is the only one of its text and passes
straight through. The others, true repeats and a few false alarms, are the only rows that are grouped
by digest. The filter has ``BITS_PER_ROW`` bits a row, up to ``max_bits``; beyond that it lets more
rows through to the grouping, which changes the cost and never the result.

Rules for odd input: a null text equals an empty one; a null id sorts after every other; of rows alike
in text, length and id exactly one stays; an empty table gives an empty result; other columns, whatever
their names, are untouched.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import as_row, staged, without_spaces

BITS_PER_ROW = 16
#: The filter is broadcast; this many bits are 32 MB.
MAX_BITS = 1 << 28
#: Bits in one bitmap of Spark's ``bitmap_construct_agg``.
BITMAP_BITS = 32768


def digest_columns(id_col: str = "doc_id", text_col: str = "text") -> tuple[Column, ...]:
    """Id, code points of the original, and digest of the text without white space."""
    return (
        F.col(id_col).cast("long").alias("doc_id"),
        F.length(F.coalesce(F.col(text_col), F.lit(""))).cast("long").alias("n_code_points"),
        F.sha2(without_spaces(F.col(text_col)), 256).alias("text_sha256"),
    )


def _slots(bits: int) -> tuple[Column, Column]:
    """Two slots, from 1 to ``bits``, as Spark's bitmap functions count them."""
    digest = F.col("text_sha256")
    return tuple(
        F.pmod(F.xxhash64(digest, F.lit(seed)), F.lit(bits)) + F.lit(1) for seed in (17, 71)
    )


def filter_bits(rows: int, max_bits: int = MAX_BITS) -> int:
    """A power of two: at least ``BITS_PER_ROW`` bits a row, within ``max_bits``."""
    wanted = max(BITMAP_BITS, rows * BITS_PER_ROW)
    return min(max_bits, 1 << (wanted - 1).bit_length())


def crowded_slots(keys: DataFrame, bits: int) -> DataFrame:
    """Pass one: bitmaps of the slots that were hit more than once, by bitmap number."""
    hits = keys.select(F.explode(F.array(*_slots(bits))).alias("slot")).groupBy("slot").count()
    return (
        hits.filter("count > 1")
        .groupBy(F.call_function("bitmap_bucket_number", "slot").alias("bitmap_no"))
        .agg(
            F.call_function(
                "bitmap_construct_agg", F.call_function("bitmap_bit_position", F.col("slot"))
            ).alias("bitmap")
        )
    )


def _bit(bitmap: Column, slot: Column) -> Column:
    place = F.call_function("bitmap_bit_position", slot)
    byte = F.conv(F.hex(F.substring(bitmap, (place / 8).cast("int") + 1, F.lit(1))), 16, 10)
    return F.coalesce(F.getbit(byte.cast("int"), (place % 8).cast("int")) == 1, F.lit(False))


def with_alarm(keys: DataFrame, crowded: DataFrame, bits: int) -> DataFrame:
    """Pass two: ``possibly_repeated``, true if both slots of a row were hit more than once."""
    tested = keys
    alarm = F.lit(True)
    for i, slot in enumerate(_slots(bits)):
        bitmaps = F.broadcast(
            crowded.select(
                F.col("bitmap_no").alias(f"bitmap_no_{i}"), F.col("bitmap").alias(f"bitmap_{i}")
            )
        )
        number = F.call_function("bitmap_bucket_number", slot)
        tested = tested.join(bitmaps, number == F.col(f"bitmap_no_{i}"), "left")
        alarm = alarm & _bit(F.col(f"bitmap_{i}"), slot)
    return tested.withColumn("possibly_repeated", alarm).drop(
        "bitmap_no_0", "bitmap_no_1", "bitmap_0", "bitmap_1"
    )


def _repeats(alarmed: DataFrame) -> DataFrame:
    """Rows alike in digest, length and id once, with their number."""
    return (
        alarmed.groupBy("text_sha256", "n_code_points", "doc_id")
        .agg(F.count(F.lit(1)).alias("copies"))
    )


def _groups(repeats: DataFrame) -> DataFrame:
    """Per digest the row that stays: most code points, then smallest id, null last."""
    best = F.max(
        F.struct(
            F.col("n_code_points"),
            F.col("doc_id").isNotNull().alias("has_id"),
            (-F.col("doc_id")).alias("minus_id"),
        )
    )
    return repeats.groupBy("text_sha256").agg(
        best.alias("best"), F.sum("copies").alias("group_size")
    ).select(
        "text_sha256",
        (-F.col("best.minus_id")).alias("keep_id"),
        F.col("best.n_code_points").alias("keep_code_points"),
        "group_size",
    )


def _tested(docs: DataFrame, id_col: str, text_col: str, max_bits: int):
    keys = staged(docs.select(*digest_columns(id_col, text_col)), "digests")
    bits = filter_bits(keys.count(), max_bits)
    crowded = staged(crowded_slots(keys, bits), "crowded")
    return keys, crowded, bits


def decisions(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_bits: int = MAX_BITS
) -> DataFrame:
    """A row per document: doc_id, keep_id, group_size, kept, text_sha256."""
    keys, crowded, bits = _tested(docs, id_col, text_col, max_bits)
    tested = with_alarm(keys, crowded, bits)
    alone = tested.filter(~F.col("possibly_repeated")).select(
        "doc_id",
        F.col("doc_id").alias("keep_id"),
        F.lit(1).cast("long").alias("group_size"),
        F.lit(True).alias("kept"),
        "text_sha256",
    )
    repeats = staged(_repeats(tested.filter("possibly_repeated")), "repeats")
    groups = staged(_groups(repeats), "groups")
    stays = F.col("doc_id").eqNullSafe(F.col("keep_id")) & (
        F.col("n_code_points") == F.col("keep_code_points")
    )
    grouped = (
        repeats.join(groups, "text_sha256")
        .withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), "copies")))
        .select(
            "doc_id", "keep_id", "group_size", (stays & (F.col("copy") == 1)).alias("kept"), "text_sha256"
        )
    )
    return alone.unionByName(grouped)


def keep_first(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_bits: int = MAX_BITS
) -> DataFrame:
    """``docs`` with all its columns, without the rows that ``decisions`` drops.

    Only rows with an alarm are shuffled, by digest and id; a third of all rows in one group meets its
    one surviving key and leaves, since the others have another id.
    """
    keys, crowded, bits = _tested(docs, id_col, text_col, max_bits)
    tested_keys = with_alarm(keys, crowded, bits).filter("possibly_repeated")
    stays = staged(_groups(_repeats(tested_keys)), "stays").select(
        F.col("text_sha256").alias("keep_sha256"),
        F.coalesce("keep_id", F.lit(0)).alias("keep_id"),
        F.col("keep_id").isNull().alias("keep_null"),
        F.col("keep_code_points"),
    )
    rows = docs.select(as_row(docs), *digest_columns(id_col, text_col))
    tested = with_alarm(rows, crowded, bits)
    alone = tested.filter(~F.col("possibly_repeated")).select("doc.*")
    kept = (
        tested.filter("possibly_repeated")
        .join(
            stays,
            (F.coalesce("doc_id", F.lit(0)) == F.col("keep_id"))
            & (F.col("doc_id").isNull() == F.col("keep_null"))
            & (F.col("text_sha256") == F.col("keep_sha256"))
            & (F.col("n_code_points") == F.col("keep_code_points")),
            "left_semi",
        )
        .dropDuplicates(["doc_id", "text_sha256"])
        .select("doc.*")
    )
    return alone.unionByName(kept)
