"""The registered queries of this subpackage; each takes (spark, sf_dir)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aislewise.llm.common import fold, read_table
from aislewise.llm.decontaminate import find_leaks
from aislewise.llm.divergence import audit_sources
from aislewise.llm.gru_lm import score_documents
from aislewise.llm.html_extract import extract_text
from aislewise.llm.language_id import identify_languages, train_languages
from aislewise.llm.licenses import find_licenses, summarise_licenses
from aislewise.llm.ngram_join import JoinRule, component_of_documents
from aislewise.llm.quality_rules import clean_lines
from aislewise.llm.sentencepiece_wfst import MODEL, encode_documents, load_transducer
from aislewise.llm.sharding import assign_shards
from aislewise.llm.token_alignment import AlignmentSettings, align_tokens
from aislewise.llm.toxicity import score_toxicity, train_toxicity
from aislewise.llm.url_rules import UrlRule, judge_urls

BYTE_BPE = "/opt/tokenizers/byte_bpe_50k.json"
URL_RULES = (
    UrlRule("allow", "org", "/"),
    UrlRule("block", "example.org", "/es/"),
    UrlRule("block", "example.org", "/en/1"),
    UrlRule("allow", "com", "/fr/"),
    UrlRule("block", "com", "/de/"),
)


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean_lines(read_table(spark, sf_dir, "documents")).drop("clean_text")


def op2_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_text(read_table(spark, sf_dir, "pages"))


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    remainder = fold(F.col("doc_id"), 4)
    model = train_languages(docs.where(remainder != 2))
    found = identify_languages(docs, model)
    return found.select("doc_id", (remainder == 2).alias("held_out"), "lang_pred", "score")


def op4_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return component_of_documents(docs, JoinRule(words=3, percent=90))


def op5_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_documents(read_table(spark, sf_dir, "documents"), load_transducer())


def op6_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, benchmark = (read_table(spark, sf_dir, t) for t in ("documents", "benchmark"))
    return find_leaks(docs, benchmark)


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = (read_table(spark, sf_dir, t) for t in ("documents", "labels"))
    remainder = fold(F.col("doc_id"), 5)
    model = train_toxicity(docs, labels.where(remainder != 0))
    found = score_toxicity(docs, model)
    return found.select("doc_id", (remainder == 0).alias("held_out"), "score", "predicted")


def op8_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages, labels = (read_table(spark, sf_dir, t) for t in ("pages", "labels"))
    return judge_urls(pages, labels, URL_RULES).drop("confidence")


def op9_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    remainder = fold(F.col("doc_id"), 5)
    scored = score_documents(docs, docs.where(remainder != 1))
    return scored.withColumn("held_out", remainder == 1)


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return assign_shards(read_table(spark, sf_dir, "documents"))


def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit_sources(read_table(spark, sf_dir, "documents"))


def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align_tokens(read_table(spark, sf_dir, "documents"), AlignmentSettings(BYTE_BPE, MODEL))


def op13_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summarise_licenses(find_licenses(read_table(spark, sf_dir, "documents")))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_quality_rules,
        op2_html_extraction,
        op3_language_id,
        op4_ngram_jaccard_join,
        op5_sentencepiece,
        op6_benchmark_decontamination,
        op7_toxicity,
        op8_url_filters,
        op9_lm_scoring,
        op10_sharding,
        op11_source_divergence,
        op12_token_alignment,
        op13_license_scans,
    )
}
