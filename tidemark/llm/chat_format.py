"""Chat formatting as relational work: DataFrame functions only.

The turns of a conversation are collected as structs and sorted; neighbours of one role are merged into one message by joining
the slice of their texts; the messages are concatenated. A message is ``<s>`` + opening + texts + closing
+ ``</s>``, with the marks of ``MARKS`` by role, ``[ROLE]name[/ROLE]`` before any other role, and ``[NEXT]`` between merged
texts. Inside texts and role names a backslash is doubled and every control string gets a backslash after its
first character, so no text can pose as a mark and reading back is exact.

The conversation is also given as ``segments`` of text and a flag: the segments add up to the formatted text,
and the flag is the loss mask, true for what an assistant says and for nothing else.

Rules for odd input: null texts and roles are empty; turns are ordered by number (null first), then role, then text, so
ties and repeated rows keep a fixed order and each counts; a null conversation id is a conversation; an empty table
gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BEGIN, END, NEXT = "<s>", "</s>", "[NEXT]"
ROLE_OPEN, ROLE_CLOSE = "[ROLE]", "[/ROLE]"
# What opens and closes the texts of a role.
MARKS = {"system": ("<<SYS>>", "<</SYS>>"), "user": ("[INST]", "[/INST]"), "assistant": ("", "")}
CONTROLS = (BEGIN, END, NEXT, ROLE_OPEN, ROLE_CLOSE, *(m for pair in MARKS.values() for m in pair if m))

LEARNED_ROLE = "assistant"


def escaped(text: Column) -> Column:
    out = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    for control in CONTROLS:
        out = F.replace(out, F.lit(control), F.lit(f"{control[0]}\\{control[1:]}"))
    return out


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def _opening(role: Column) -> Column:
    out = F.concat(F.lit(ROLE_OPEN), escaped(role), F.lit(ROLE_CLOSE))
    for name, (mark, _) in MARKS.items():
        out = F.when(role == name, F.lit(mark)).otherwise(out)
    return out


def _closing(role: Column) -> Column:
    out = F.lit("")
    for name, (_, mark) in MARKS.items():
        out = F.when(role == name, F.lit(mark)).otherwise(out)
    return out


def _segment(text: Column, loss: Column) -> Column:
    return F.struct(text.alias("text"), loss.alias("loss"))


def formatted(turns: DataFrame) -> DataFrame:
    """conv_id, formatted and segments, a row per conversation, from rows of conv_id, turn, role, text."""
    role = F.coalesce(F.col("role").cast("string"), F.lit(""))
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    collected = turns.groupBy("conv_id").agg(
        F.sort_array(
            F.collect_list(F.struct(F.col("turn"), role.alias("role"), text.alias("text")))
        ).alias("turns")
    )
    last = F.size("turns") - 1
    begins = F.filter(
        F.sequence(F.lit(0), last),
        lambda i: (i == 0) | (F.col("turns")[i]["role"] != F.col("turns")[F.greatest(i - 1, F.lit(0))]["role"]),
    )
    ends = F.concat(F.slice("begins", 2, F.size("begins")), F.array(F.size("turns")))
    merged = F.transform(
        F.arrays_zip(F.col("begins").alias("first"), ends.alias("after")),
        lambda m: F.struct(
            F.col("turns")[m["first"]]["role"].alias("role"),
            F.transform(
                F.slice(F.col("turns"), m["first"] + 1, m["after"] - m["first"]), lambda t: escaped(t["text"])
            ).alias("texts"),
        ),
    )
    quiet = F.lit(False)

    def segments(message: Column) -> Column:
        role, texts = message["role"], message["texts"]
        said = F.flatten(
            F.transform(
                texts,
                lambda text, i: F.array(
                    _segment(F.when(i > 0, F.lit(NEXT)).otherwise(F.lit("")), quiet),
                    _segment(text, role == LEARNED_ROLE),
                ),
            )
        )
        return F.concat(
            F.array(_segment(F.concat(F.lit(BEGIN), _opening(role)), quiet)),
            said,
            F.array(_segment(F.concat(_closing(role), F.lit(END)), quiet)),
        )

    rows = (
        collected.withColumn("begins", begins)
        .withColumn("messages", merged)
        .withColumn("segments", F.flatten(F.transform("messages", segments)))
    )
    whole = F.array_join(F.transform("segments", lambda s: s["text"]), "")
    return rows.select("conv_id", whole.alias("formatted"), "segments")


def _literal(text: str) -> str:
    return rf"\Q{text}\E"


def read_back(text: Column) -> Column:
    """The turns in a formatted text: array of (role, text)."""

    def turns(message: Column) -> Column:
        message = F.substr(message, F.lit(len(BEGIN) + 1))
        role_end = F.instr(message, ROLE_CLOSE)
        role = F.lit(LEARNED_ROLE)
        body = message
        for name, (opening, closing) in MARKS.items():
            if opening:
                inner = F.substr(
                    message, F.lit(len(opening) + 1), F.length(message) - len(opening) - len(closing)
                )
                here = F.startswith(message, F.lit(opening))
                role, body = F.when(here, F.lit(name)).otherwise(role), F.when(here, inner).otherwise(body)
        other = F.startswith(message, F.lit(ROLE_OPEN))
        name = F.substr(message, F.lit(len(ROLE_OPEN) + 1), role_end - len(ROLE_OPEN) - 1)
        role = F.when(other, unescaped(name)).otherwise(role)
        body = F.when(other, F.substr(message, role_end + len(ROLE_CLOSE))).otherwise(body)
        return F.transform(
            F.split(body, _literal(NEXT), -1),
            lambda t: F.struct(role.alias("role"), unescaped(t).alias("text")),
        )

    # What follows the last end mark is empty.
    messages = F.split(text, _literal(END), -1)
    return F.flatten(F.transform(F.slice(messages, 1, F.size(messages) - 1), turns))


def learned_text(segments: Column) -> Column:
    """What stands under the loss mask, unescaped."""
    return F.array_join(F.transform(F.filter(segments, lambda s: s["loss"]), lambda s: unescaped(s["text"])), "")


def digests(conversations: DataFrame) -> DataFrame:
    """A row per formatted conversation, all from the output: numbers and digests of turns and loss text."""
    told = F.array_join(
        F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), ""
    )
    return (
        conversations.withColumn("turns", read_back(F.col("formatted")))
        .withColumn("learned", learned_text(F.col("segments")))
        .select(
            "conv_id",
            F.size("turns").cast("long").alias("n_turns"),
            F.sha2(told, 256).alias("turns_sha256"),
            F.length("learned").cast("long").alias("loss_chars"),
            F.sha2("learned", 256).alias("loss_sha256"),
            F.length("formatted").cast("long").alias("formatted_chars"),
        )
    )
