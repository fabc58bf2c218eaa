"""The queries of this subpackage over the given tables, and the SQL that some of them are checked with."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from promptmill.llm.conversation_repair import repair_report
from promptmill.llm.decontaminate import CONTAMINATION_SQL, contamination_report
from promptmill.llm.langid import language_report
from promptmill.llm.lexical_search import SEARCH_SQL, search_report
from promptmill.llm.line_dedup import LINE_DEDUP_SQL, line_dedup_digest
from promptmill.llm.near_dup import near_duplicate_report
from promptmill.llm.quality import quality_report
from promptmill.llm.secrets import secret_report
from promptmill.llm.shared import read_table, tokenizer_path
from promptmill.llm.spm import piece_report
from promptmill.llm.token_counts import token_count_report
from promptmill.llm.token_files import token_file_digest
from promptmill.llm.url_rules import url_report, url_rules_sql
from promptmill.llm.vector_forest import VECTOR_SQL, vector_report


def op1_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return piece_report(read_table(spark, sf_dir, "documents"), tokenizer_path("piece_bpe_32k.model"))


def op2_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_file_digest(read_table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"))


def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_report(read_table(spark, sf_dir, "documents"))


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup_digest(read_table(spark, sf_dir, "documents"))


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_report(read_table(spark, sf_dir, "documents"))


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_report(read_table(spark, sf_dir, "documents"))


def op7_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicate_report(read_table(spark, sf_dir, "documents"))


def op8_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_report(read_table(spark, sf_dir, "pages"))


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination_report(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_count_report(read_table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"))


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair_report(read_table(spark, sf_dir, "conversations"))


def op12_vector_near_dups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_report(read_table(spark, sf_dir, "embeddings"))


def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search_report(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_sentencepiece": op1_sentencepiece,
    "op2_token_files": op2_token_files,
    "op3_secret_scan": op3_secret_scan,
    "op4_line_dedup": op4_line_dedup,
    "op5_quality_rules": op5_quality_rules,
    "op6_language_id": op6_language_id,
    "op7_near_duplicates": op7_near_duplicates,
    "op8_url_rules": op8_url_rules,
    "op9_decontamination": op9_decontamination,
    "op10_token_counts": op10_token_counts,
    "op11_conversation_repair": op11_conversation_repair,
    "op12_vector_near_dups": op12_vector_near_dups,
    "op13_lexical_search": op13_lexical_search,
}

ORACLES: dict[str, str] = {
    "op4_line_dedup": LINE_DEDUP_SQL,
    "op8_url_rules": url_rules_sql(),
    "op9_decontamination": CONTAMINATION_SQL,
    "op12_vector_near_dups": VECTOR_SQL,
    "op13_lexical_search": SEARCH_SQL,
}
