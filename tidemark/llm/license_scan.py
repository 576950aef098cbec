"""License scan by ordered signature rules; DataFrame functions only.

A keyword prefilter first: texts without any keyword of the rules are done with after one look. The others are
brought into words in lower case with one space between, meet only the rules of the keywords they have, and
give detections as intervals of words. A detection that lies inside one of higher priority, or of the same
priority and longer, is suppressed. What the base phrases find always counts.

Rules for odd input: null and empty texts have no words, empty labels and score 0; rows that share an id or a text are
handled as they are; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.common import LOWER, UPPER, staged
from tidemark.llm.license_rules import BASE_RULES, Rule, rules

# What separates words, in lower case text and in any text.
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WORD_OF_ANY_CASE = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def words_line(text: Column) -> Column:
    """The words in lower case, each with one space before it, and a space at the end."""
    lowered = F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)
    return F.concat(F.lit(" "), F.trim(F.regexp_replace(lowered, SEPARATORS, " ")), F.lit(" "))


def gate(text: Column, table: list[Rule]) -> Column:
    """Whether a text may have a match: it has the anchor of a rule, in any case."""
    anchors = sorted({rule.gate() for rule in table})
    pattern = "|".join(SEPARATORS.join(re.escape(word) for word in anchor.split()) for anchor in anchors)
    return F.lower(F.coalesce(text, F.lit(""))).rlike(pattern)


def rule_table(spark: SparkSession, extra: list[Rule]) -> DataFrame:
    """All rules, the base ones marked; a constant of a few hundred rows."""
    rows = [(*rule[:5], True) for rule in BASE_RULES] + [(*rule[:5], False) for rule in extra]
    numbered = [(number, *row) for number, row in enumerate(rows)]
    return spark.createDataFrame(
        numbered, "rule int, label string, keyword string, pattern string, priority int, confidence double, base boolean"
    ).withColumn("pattern", F.concat(F.lit("(?<= )(?:"), "pattern", F.lit(")(?= )")))


def _count_words(text: Column) -> Column:
    return F.regexp_count(text, F.lit("[^ ]+"))


def detections(lines: DataFrame, table: DataFrame, keywords: list[str]) -> DataFrame:
    """doc_id, text_key, rule columns and the words [first, last] of every place, from lines that passed the gate."""
    has = F.filter(F.array(*(F.lit(k) for k in keywords)), lambda k: F.contains(F.col("line"), k))
    met = lines.withColumn("keyword", F.explode(has)).join(F.broadcast(table), "keyword")
    found = F.regexp_extract_all("line", F.col("pattern"), F.lit(0))
    places = met.withColumn("found", found).filter(F.size("found") > 0).select(
        "doc_id", "text_key", "rule", "label", "priority", "confidence", "base",
        F.posexplode(F.arrays_zip(F.split("line", F.col("pattern"), -1).alias("before"), F.col("found").alias("match"))).alias("k", "at"),
    )
    counted = staged(
        places.filter("at.match IS NOT NULL").select(
            "doc_id", "text_key", "rule", "label", "priority", "confidence", "base", "k",
            _count_words(F.col("at.before")).alias("n_before"),
            _count_words(F.col("at.match")).alias("n_match"),
        ),
        "places",
    ).dropDuplicates(["doc_id", "text_key", "rule", "k"])
    so_far = Window.partitionBy("doc_id", "text_key", "rule").orderBy("k").rowsBetween(Window.unboundedPreceding, 0)
    end = F.sum(F.col("n_before") + F.col("n_match")).over(so_far).cast("long")
    return counted.withColumn("last", end - 1).withColumn("first", F.col("last") - F.col("n_match") + 1)


def surviving(found: DataFrame, priorities: list[int]) -> DataFrame:
    """Detections that no other one contains with a higher priority, or with the same and more words.

    One scan per document by first word, longest first: a detection is contained by one before it if the
    largest last word so far, among those that outrank it, reaches its own.
    """
    scan = Window.partitionBy("doc_id", "text_key").orderBy("first", F.desc("last"), F.desc("priority"), "rule")
    before = scan.rowsBetween(Window.unboundedPreceding, -1)
    suppressed = F.lit(False)
    for priority in priorities:
        higher = F.max(F.when(F.col("priority") > priority, F.col("last"))).over(before)
        longer = F.max(F.when(F.col("priority") == priority, F.col("last"))).over(before)
        suppressed = F.when(
            F.col("priority") == priority,
            F.coalesce(higher >= F.col("last"), F.lit(False)) | F.coalesce(longer >= F.col("last"), F.lit(False)),
        ).otherwise(suppressed)
    return found.withColumn("suppressed", suppressed).filter(~F.col("suppressed")).drop("suppressed")


def scan(docs: DataFrame, extra: list[Rule] | None = None) -> DataFrame:
    """A row per document: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score."""
    extra = rules() if extra is None else extra
    table = rule_table(docs.sparkSession, extra)
    keywords = sorted({rule.keyword for rule in (*BASE_RULES, *extra)})
    text = F.col("text")
    looked = staged(
        docs.select(
            F.col("doc_id").cast("long").alias("doc_id"),
            F.xxhash64(F.coalesce(text, F.lit(""))).alias("text_key"),
            F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD_OF_ANY_CASE)).cast("long").alias("n_words"),
            F.when(gate(text, [*BASE_RULES, *extra]), words_line(text)).alias("line"),
        ),
        "looked",
    )
    found = staged(detections(looked.filter("line IS NOT NULL"), table, keywords), "found")
    outranked = surviving(found.filter("NOT base"), sorted({rule.priority for rule in extra}))
    base = F.col("base")
    per_document = (
        found.filter("base")
        .unionByName(outranked)
        .groupBy("doc_id", "text_key")
        .agg(
            F.sum(base.cast("long")).alias("n_base"),
            F.min(F.when(base, F.col("first"))).alias("first_word"),
            F.max(F.when(base, F.col("first"))).alias("last_word"),
            F.collect_set(F.when(base, F.col("label"))).alias("base_set"),
            F.collect_set("label").alias("label_set"),
            F.max("confidence").alias("confidence"),
        )
        .withColumnsRenamed({"doc_id": "of_id", "text_key": "of_key"})
    )
    rows = looked.drop("line")
    same = F.col("doc_id").eqNullSafe(F.col("of_id")) & (F.col("text_key") == F.col("of_key"))
    joined = lambda labels: F.coalesce(F.array_join(F.array_sort(labels), ","), F.lit(""))
    return rows.join(per_document, same, "left").select(
        "doc_id",
        "n_words",
        F.coalesce("n_base", F.lit(0)).cast("long").alias("n_base"),
        "first_word",
        "last_word",
        joined(F.col("base_set")).alias("base_labels"),
        joined(F.col("label_set")).alias("labels"),
        F.coalesce("confidence", F.lit(0.0)).alias("score"),
    )
