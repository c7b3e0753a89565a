"""The operators of this subpackage as named queries over the given tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rillrank.llm import (decontaminate, language, licenses, lm, near_dup, packing, personal, quality, ranked_search,
                          substrings, token_files, urls, whitening)
from rillrank.plans.inputs import table
from rillrank.session import run_dir


def _documents(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select(*(columns or ("doc_id", "text")))


def held_out(parts: int):
    """Rows whose crc32 of the id as text leaves 2; rows without an id are not held out."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % parts == 2, F.lit(False))


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    labelled = _documents(spark, sf_dir, "doc_id", "text", "lang").where(~held_out(4))
    model = language.fit(labelled)
    return language.predict(_documents(spark, sf_dir), model).select(
        "doc_id", held_out(4).alias("held_out"), "lang_pred", "score")


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality.quality_verdict(_documents(spark, sf_dir))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                         "base_failed", "kept", "dup_line_chars", *quality.GRAM_COLUMNS)


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(_documents(spark, sf_dir))


def op2_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir)
    model = lm.fit(docs.where(~held_out(7)))
    return lm.score(docs, model).select("doc_id", held_out(7).alias("held_out"), "n_tokens", "n_known",
                                        "train_tokens", "base_score", "score")


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = substrings.remove_repeats(_documents(spark, sf_dir))
    return cut.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def op4_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dup.near_duplicates(_documents(spark, sf_dir), percent=85)


def op5_token_planes(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = run_dir(spark, "token-planes")
    token_files.write_tokens(_documents(spark, sf_dir), path, public_tokenizers.path("byte_bpe_50k.json"), end_id=0)
    return token_files.read_documents(spark, path).withColumnRenamed("id", "doc_id")


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.leaks(_documents(spark, sf_dir), table(spark, sf_dir, "benchmark"))


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack(_documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"), end_id=2)
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens",
                         "sequence_id", "offset", "sequence_tokens")


#: Fixed values of the query.
URL_RULES = (
    urls.Rule("allow", "org", "/"),
    urls.Rule("block", "example.org", "/es/"),
    urls.Rule("block", "example.org", "/en/1"),
    urls.Rule("allow", "com", "/fr/"),
    urls.Rule("block", "com", "/de/"),
)


def op10_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The list holds the canonical URL of every page whose id is divisible by 50."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    listed = pages.where(F.col("page_id") % 50 == 0).select(
        urls.canonical(urls.host(F.col("url")), urls.path(F.col("url"))).alias("canonical"))
    judged = urls.url_verdicts(pages, URL_RULES, listed)
    return judged.select("page_id", "host", "path", "rule", "verdict", "listed")


def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = ranked_search.build(_documents(spark, sf_dir), "doc_id", "text")
    return ranked_search.search(index, table(spark, sf_dir, "benchmark"), "item_id", "text", k=10)


def op12_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal.digest(personal.spans(_documents(spark, sf_dir), "doc_id", "text"), "doc_id")


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return whitening.whiten(vectors, whitening.fit(vectors, "embedding", components=4), "embedding", "vec_id")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_license_scan": op1_license_scan,
    "op2_lm_scoring": op2_lm_scoring,
    "op3_substring_dedup": op3_substring_dedup,
    "op4_near_dup": op4_near_dup,
    "op5_token_planes": op5_token_planes,
    "op6_decontamination": op6_decontamination,
    "op7_language_id": op7_language_id,
    "op8_quality_rules": op8_quality_rules,
    "op9_packing": op9_packing,
    "op10_url_filters": op10_url_filters,
    "op11_ranked_search": op11_ranked_search,
    "op12_personal_data": op12_personal_data,
    "op13_whitening": op13_whitening,
}
