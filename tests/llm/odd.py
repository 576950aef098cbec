"""Documents of every odd kind, and an empty table of them."""

from __future__ import annotations

import random

from pyspark.sql import DataFrame, SparkSession

# Columns beyond those of documents, with names that operators use themselves.
SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, "
    "kept string, score string, doc string, found string, vertex string, n string, tokens string, "
    "draw string, topic string, text_sha256 string, ranges string, line string, probability string, mix_weight string, "
    "dropped_id string, own_id string, leader string, key string, of_key string, item_id string, seed string, text_key string"
)
N_EXTRA = len(SCHEMA.split(", ")) - 5

WORDS = ["alpha", "beta", "gamma", "delta", "of", "the", "Rain", "über", "ñandú", "wörter"]


def prose(seed: int, n: int) -> str:
    r = random.Random(seed)
    return " ".join(r.choice(WORDS) + str(r.randrange(400)) + r.choice(["", "", "", "."]) for _ in range(n))


LONG = prose(1, 60_000)

ROWS = [
    (1, None, "en", "a", 0),
    (2, "", "en", "a", 0),
    (3, " \t\n\x0b\x0c\r ", None, None, None),
    (4, "one", "en", "a", 3),
    (5, "two words", "en", "a", 9),
    (6, prose(2, 80), "en", "a", 1),
    (7, prose(2, 80), "de", "b", 1),
    (7, prose(2, 80), "de", "b", 1),
    (7, prose(2, 80), "de", "b", 1),
    (8, prose(2, 80) + "  ", "fr", None, 1),
    (9, prose(2, 78) + " other end", "fr", "c", 1),
    (None, prose(2, 80), None, "c", None),
    (None, prose(3, 50), "en", "c", None),
    (None, None, None, None, None),
    (10, LONG, "en", "a", 1),
    (11, LONG + " x", "en", "a", 1),
    (-5, prose(4, 30) + "\n" + prose(4, 30) + "\n\n" + prose(5, 30), "en", "d", 1),
    (12, "😀".encode("utf-16", "surrogatepass").decode("utf-16") * 3 + " é    ", "en", "d", 1),
    (13, "a " * 5000, "en", "d", 1),
    (14, "a " * 5001, "en", "d", 1),
]


def documents(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(*row, *["x"] * N_EXTRA) for row in ROWS], SCHEMA)


def no_documents(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], SCHEMA)
