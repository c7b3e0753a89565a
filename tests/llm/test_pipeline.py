"""The pipeline's stages, each against brute force on what the stage before kept, and the registered queries."""

from __future__ import annotations

import random

import pytest

import __spark_entry__ as entry
import corpus_pipeline as pipeline
from rillrank.llm import oracle, queries
from tests.check import compare, connect
from tests.llm.test_text_operators import brute_components, brute_repeats, encoded, WORDS
from tests.llm.texts import ODD, documents, frame


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """A folder with documents and a benchmark, some of whose items stand in documents."""
    folder = tmp_path_factory.mktemp("tables")
    rnd = random.Random(12)
    items = [(i, " ".join(rnd.choices([f"q{k}" for k in range(500)], k=30))) for i in range(20)]
    rows = documents(80) + [r for r in ODD if r[0] != 1007]
    rows += [(4000 + i, f"before {text} after " + " ".join(rnd.choices([f"z{k}" for k in range(99)], k=30)), "en", "s", 0, None)
             for i, text in items[:6]]
    frame(spark, rows).drop("score").write.parquet(str(folder / "documents.parquet"))
    spark.createDataFrame(items, "item_id bigint, text string").write.parquet(str(folder / "benchmark.parquet"))
    return str(folder), rows


def test_stages(spark, tables):
    folder, rows = tables
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns, now, stages = docs.columns, docs, dict(pipeline.STAGES)
    kept = {}
    for name in ("language", "near_dup", "substrings", "decontamination"):
        now = stages[name](spark, now, folder)
        assert now.columns == columns and now.schema == docs.schema
        kept[name] = {r.doc_id: r.text for r in now.collect()}
    texts = {r[0]: r[1] for r in rows}
    assert kept["language"] == {i: t for i, t in texts.items() if t and any(map(str.isalpha, t))}
    known = [(i, t) for i, t in kept["language"].items() if i is not None]
    assert kept["near_dup"] == {i: kept["language"][i] for i, _, _, own in brute_components(known, 80) if own} | {
        None: texts[None]}
    given = [(i, t) for i, t in kept["near_dup"].items() if i is not None]
    assert kept["substrings"] == {i: rest if gone else kept["near_dup"][i]
                                  for i, n, gone, rest in brute_repeats(given, 50) if not n or gone < n} | {None: texts[None]}
    assert set(kept["substrings"]) - set(kept["decontamination"]) == {4000 + i for i in range(6)}
    pieces = pipeline.run(spark, folder).groupBy("doc_id").sum("length").collect()
    assert {r[0]: r[1] for r in pieces} == {i: len(encoded(WORDS, 2, t)) for i, t in kept["decontamination"].items()}


def test_an_empty_table(spark, tables, tmp_path):
    folder, _ = tables
    for name in ("documents", "benchmark"):
        spark.read.parquet(f"{folder}/{name}.parquet").where("false").write.parquet(str(tmp_path / f"{name}.parquet"))
    assert pipeline.run(spark, str(tmp_path)).count() == 0


@pytest.mark.parametrize("name", queries.QUERIES)
def test_queries_equal_their_sql(spark, sf_dir, name):
    assert compare(spark, connect(sf_dir), name, entry.queries()[name], oracle.SQL.get(name), sf_dir) == ""


def test_all_are_registered():
    assert {n.split("_")[0] for n in queries.QUERIES} == {f"op{i}" for i in range(1, 14)}
    assert {*queries.QUERIES, "pipeline"} <= set(entry.queries()) and set(oracle.SQL) <= set(entry.oracle_sql())
    assert [n for n, _ in pipeline.STAGES] == ["language", "near_dup", "substrings", "decontamination", "packing"]
