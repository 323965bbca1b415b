"""The corpus pipeline: documents through filters and joins to token ids."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from aislewise.llm.common import read_table, stage
from aislewise.llm.decontaminate import drop_leaks
from aislewise.llm.language_id import keep_identified, train_languages
from aislewise.llm.ngram_join import JoinRule, drop_near_duplicates
from aislewise.llm.sentencepiece_wfst import encode_documents, load_transducer
from aislewise.llm.toxicity import drop_toxic, train_toxicity

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without documents whose language the model, learned from `docs`, does not accept."""
    return keep_identified(docs, train_languages(docs))


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without documents that score as toxic; learned from those that `labels` has."""
    return drop_toxic(docs, train_toxicity(docs, read_table(spark, sf_dir, "labels")))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by five-word shingles at similarity 0.8 or more."""
    return drop_near_duplicates(docs, JoinRule(words=5, percent=80))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without documents that have a passage of the benchmark."""
    return drop_leaks(docs, read_table(spark, sf_dir, "benchmark"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Piece numbers of what is left."""
    return encode_documents(docs, load_transducer())


STAGES: list[tuple[str, Stage]] = [
    ("language", language),
    ("toxicity", toxicity),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("tokens", tokens),
]
#: Trained models, hashed shingles and tokenizer files have no SQL form.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`, each written as Parquet and reread by the next."""
    docs = read_table(spark, sf_dir, "documents")
    for k, (name, step) in enumerate(STAGES):
        docs = step(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = stage(docs, name)
    return docs
