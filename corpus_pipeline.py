"""The training-data pipeline: STAGES applied in order to `documents`.

Each stage takes all that the one before kept and returns the columns it was given, but for the last,
which returns the pieces of the packed sequences. Stages write what they need to see again, and what
they return, under spark.checkpoint.dir.

Nulls: documents without a text have no language and go at the first stage. Documents without an id are
kept by every filter. Equal ids: judged each by its text. An empty table gives no pieces.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rillrank.llm import decontaminate, language, near_dup, packing, substrings
from rillrank.llm.queries import held_out
from rillrank.llm.tables import saved
from rillrank.plans.inputs import table

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

SIMILAR_PERCENT = 80


def _as_given(docs: DataFrame) -> list:
    return [F.col(f"`{c}`") for c in docs.columns]


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents in which no language can be told: without a text, or without a letter. Where no label can be
    learned from, only those without a letter are dropped."""
    model = language.fit(docs.where(~held_out(4)))
    if not model.languages:
        return language.with_letters(docs)
    return language.predict(docs, model).where(F.col("lang_pred") != language.UNKNOWN).select(*_as_given(docs))


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the smallest id of each group of near-duplicates."""
    return near_dup.keep_first(docs, percent=SIMILAR_PERCENT)


def without_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts passages that a smaller id holds. Documents of which nothing is left go; untouched texts stay as they are."""
    cut = substrings.remove_repeats(docs)
    touched = F.col("n_removed") > 0
    kept = cut.where(~touched | (F.col("n_removed") < F.col("n_words")))
    text = F.when(touched, F.col("kept_text")).otherwise(F.col("text"))
    changed = {"text": text, "n_chars": F.when(touched, F.char_length("kept_text")).otherwise(F.col("n_chars"))}
    return kept.select(*[changed[c].cast(docs.schema[c].dataType).alias(c) if c in changed else F.col(f"`{c}`")
                         for c in docs.columns])


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold a benchmark item."""
    found = saved(decontaminate.leaks(docs, table(spark, sf_dir, "benchmark")), "leaks")
    return decontaminate.without_leaks(docs, found)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    pieces = packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"), end_id=2)
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens",
                         "sequence_id", "offset", "sequence_tokens")


STAGES: list[tuple[str, Stage]] = [
    ("language", known_language),
    ("near_dup", one_of_each_group),
    ("substrings", without_repeats),
    ("decontamination", without_benchmark),
    ("packing", packed),
]

#: Language models, tokenizers and connected components are beyond SQL; the tests use brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = saved(docs, f"pipeline-{name}")
    return docs
