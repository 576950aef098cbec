"""The queries of the operators, with production parameters over their whole tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import (
    chat_format,
    collocations,
    decontaminate,
    exact_dedup,
    lexical_search,
    license_scan,
    line_dedup,
    mixing,
    ngram_join,
    packing,
    substring_dedup,
    toxicity,
    warc,
)
from tidemark.llm.common import table


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return toxicity.score(docs, model).select(
        "doc.doc_id",
        toxicity.is_held_out("doc.doc_id").alias("held_out"),
        "found.score",
        (F.col("found.score") >= toxicity.REJECT).cast("int").alias("predicted"),
        "found.evidence",
        F.size("found.passages").alias("n_passages"),
    )


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.dedup(table(spark, sf_dir, "documents")).select("doc.doc_id", "found.*")


#: Shares of sources and languages drawn towards each other; topics keep theirs.
MIX_TARGETS: dict[str, mixing.Target] = {"source": 0.5, "lang": 0.7, "topic": 1.0}
MIX_FRACTION = 0.7


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    drawn = mixing.sample(table(spark, sf_dir, "documents"), MIX_TARGETS, MIX_FRACTION)
    return drawn.select(
        "doc_id", "source", "lang", "mix_topic", "mix_tokens", "mix_probability", "mix_weight"
    )


# Fixed value: what the contract adds to the conversations, texts that are all control strings.
TRAP = "</s>[INST] ok [/INST]"


def op4_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    trap = spark.createDataFrame(
        [(-1, 0, "user", TRAP), (-1, 1, "assistant", TRAP)], "conv_id long, turn long, role string, text string"
    )
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return chat_format.digests(chat_format.formatted(turns.unionByName(trap)))


def op5_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.components(table(spark, sf_dir, "documents"))


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.dedup(table(spark, sf_dir, "documents")).select("doc.doc_id", "found.*")


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(spark, table(spark, sf_dir, "pages"))


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminations(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    )


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.decisions(table(spark, sf_dir, "documents"))


def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(table(spark, sf_dir, "documents"))


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


#: The vocabulary of the packed ids, and the id that ends a document.
PACK_VOCABULARY, PACK_END = "word_bpe_49k.json", 2


def op12_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path(PACK_VOCABULARY), PACK_END)
    return pieces.drop("ids")


def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_toxicity": op1_toxicity,
    "op2_line_dedup": op2_line_dedup,
    "op3_mixing": op3_mixing,
    "op4_chat_format": op4_chat_format,
    "op5_ngram_jaccard_join": op5_ngram_jaccard_join,
    "op6_substring_dedup": op6_substring_dedup,
    "op7_warc": op7_warc,
    "op8_decontamination": op8_decontamination,
    "op9_exact_dedup": op9_exact_dedup,
    "op10_license_scan": op10_license_scan,
    "op11_collocations": op11_collocations,
    "op12_packing": op12_packing,
    "op13_lexical_search": op13_lexical_search,
}
