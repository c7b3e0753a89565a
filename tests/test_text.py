from __future__ import annotations

import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from rillrank.functions import text
from rillrank.plans import jobs


def lines(spark, *values):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], "seq bigint, value string")


def expected(value: str, pattern: str) -> list[str]:
    if value == "":
        return [""]
    parts = re.split(pattern, value)
    while parts and parts[-1] == "":
        parts.pop()
    return parts


CASES = ["a,,b,,", "", ",,", "a", ",a", "a b  c ", "  ", "x\ty\n", "\n", "a, b\tc", ", ,", "a..b.", "。,é,"]


@pytest.mark.parametrize("pattern", [",", " ", "\\s", "[.]", ", ?"])
def test_java_split(spark, pattern):
    got = lines(spark, *CASES).orderBy("seq").select(text.java_split(F.col("value"), pattern).alias("p")).collect()
    assert [r.p for r in got] == [expected(c, pattern) for c in CASES]


@settings(max_examples=5, deadline=None)
@given(st.lists(st.text(alphabet="ab, \t.", max_size=12), min_size=1, max_size=200))
def test_java_split_any_text(spark, values):
    rows = lines(spark, *values).select(
        "value", *[text.java_split(F.col("value"), p).alias(f"p{i}") for i, p in enumerate([",", "\\s", "[.]"])]
    ).collect()
    for row in rows:
        for i, p in enumerate([",", "\\s", "[.]"]):
            assert row[f"p{i}"] == expected(row.value, p)


def test_null_text_gives_no_words(spark):
    assert text.tokenise(lines(spark, None), ",").count() == 0


def test_tokenise_keeps_inner_empty_fields(spark):
    assert [r.word for r in text.tokenise(lines(spark, "B,,a,"), ",").collect()] == ["B", "", "a"]


def test_tokenise_lower_drops_empty_fields(spark):
    rows = text.pair_with_one(text.tokenise_lower(lines(spark, "Hello,,STREAM,", "hello,world"))).collect()
    assert [(r.word, r.cnt) for r in rows] == [("hello", 1), ("stream", 1), ("hello", 1), ("world", 1)]


def test_append_suffix_and_keep_word(spark):
    df = lines(spark, "a", "b")
    assert [r[0] for r in df.select(text.append_suffix(F.col("value"))).collect()] == ["aaaaaa", "baaaaa"]
    assert [r.seq for r in text.keep_word(df, "a", "value").collect()] == [0]


def test_word_count_lines(spark):
    rows = text.parse_word_count(lines(spark, "a,5", "b,7,rest")).collect()
    assert [(r.word, r["count"]) for r in rows] == [("a", 5), ("b", 7)]


@pytest.mark.parametrize("bad", ["a", "a,x", "a,"])
def test_bad_word_count_line(spark, bad):
    with pytest.raises(Exception):
        text.parse_word_count(lines(spark, bad)).collect()
    row = text.parse_word_count(lines(spark, bad), failfast=False).collect()[0]
    assert (row.word, row["count"]) == ("a", None)


def test_split_pair(spark):
    rows = text.split_pair(lines(spark, "a,b,c")).collect()
    assert [(r["first"], r["second"]) for r in rows] == [("a", "b")]


def test_running_word_count_spells_out_each_occurrence(spark):
    got = jobs.running_word_count(lines(spark, "a,b,a", "b", "a,", "A")).orderBy("total").collect()
    assert [(r.seq, r.word, r.total) for r in got] == [(0, "a", 1), (0, "a", 2), (2, "a", 3)]


def test_running_max_over_lines(spark):
    got = jobs.running_max(lines(spark, "a,1", "a,5", "b,2", "a,3")).orderBy("seq").collect()
    assert [r.largest for r in got] == [1, 5, 2, 5]
