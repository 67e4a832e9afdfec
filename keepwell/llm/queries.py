"""The operators as named queries on the whole tables, and SQL for what SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from keepwell.llm import (
    alignment,
    bpe,
    chat,
    codebooks,
    cotrain,
    lines,
    mixing,
    pages,
    rules,
    substrings,
    superminhash,
    toxicity,
    vectors,
)
from keepwell.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.line_report(table(spark, sf_dir, "documents"))


def op2_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(bpe.encode_decode(table(spark, sf_dir, "documents")))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.learn(docs, table(spark, sf_dir, "labels")))


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.quality_verdicts(table(spark, sf_dir, "documents"))


def op5_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cotrain.quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return chat.chat_digests(turns.unionByName(chat.planted(spark)))


def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substrings.remove_repeats(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "n_removed", "kept_sha256")


def op8_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return superminhash.near_duplicates(table(spark, sf_dir, "documents"))


def op9_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.near_vectors(table(spark, sf_dir, "embeddings"))


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).select(*mixing.QUERY_COLUMNS)


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return codebooks.vector_codes(table(spark, sf_dir, "embeddings"))


def op12_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.digest_columns(alignment.aligned(table(spark, sf_dir, "documents"), digests=True))


def op13_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pages.main_text(table(spark, sf_dir, "pages"))


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        op1_line_dedup,
        op2_bpe,
        op3_toxicity,
        op4_quality_rules,
        op5_quality_classifier,
        op6_chat_formatting,
        op7_substring_dedup,
        op8_near_dedup,
        op9_embedding_dedup,
        op10_mixing,
        op11_vector_codes,
        op12_tokenizer_alignment,
        op13_html_extraction,
    )
}

ORACLES: dict[str, str] = {"op6_chat_formatting": chat.ORACLE, "op10_mixing": mixing.ORACLE}
