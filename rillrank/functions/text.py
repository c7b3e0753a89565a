"""Text-line functions: splitting, tokenising, pairs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rillrank import fixed

# Characters matched by the regex class \s.
WHITESPACE = " \t\n\x0b\f\r"
_PUNCTUATION = set("\\^$.|?*+()[]{}")


def java_split(text: Column, pattern: str) -> Column:
    """Split that drops trailing empty fields, and gives one empty field for an empty text.

    For a single-character delimiter the trailing delimiters are trimmed first, which
    stays inside generated code; any other pattern trims the resulting array.
    """
    if pattern == "\\s":
        trailing = WHITESPACE
    elif len(pattern) == 1 and pattern not in _PUNCTUATION:
        trailing = pattern
    else:
        return _split_and_cut(text, pattern)
    body = F.rtrim(text, F.lit(trailing))
    return (
        F.when(text == "", F.array(F.lit("")))
        .when(body == "", F.array().cast("array<string>"))
        .otherwise(F.split(body, pattern))
    )


def _split_and_cut(text: Column, pattern: str) -> Column:
    parts = F.split(text, pattern)
    filled = F.transform(F.reverse(parts), lambda part: F.length(part) > 0)
    # array_position is 1-based from the end; 0 means that every field is empty.
    from_end = F.array_position(filled, True)
    kept = F.when(from_end == 0, 0).otherwise(F.size(parts) - from_end.cast("int") + 1)
    return F.when(text == "", F.array(F.lit(""))).otherwise(F.slice(parts, 1, kept))


def tokenise(df: DataFrame, pattern: str, text: str = "value", out: str = "word") -> DataFrame:
    """One row per field of ``text``; empty fields inside the line are kept."""
    return df.select("*", F.explode(java_split(F.col(text), pattern)).alias(out)).drop(text)


def tokenise_lower(df: DataFrame, text: str = "value", out: str = "word") -> DataFrame:
    """Lower-case comma fields without the empty ones."""
    fields = F.filter(F.split(F.lower(F.col(text)), ","), lambda w: F.length(w) > 0)
    return df.select("*", F.explode(fields).alias(out)).drop(text)


def pair_with_one(df: DataFrame, out: str = "cnt") -> DataFrame:
    return df.withColumn(out, F.lit(1))


def append_suffix(text: Column, suffix: str = fixed.SUFFIX) -> Column:
    return F.concat(text, F.lit(suffix))


def keep_word(df: DataFrame, word: str = fixed.KEPT_WORD, column: str = "word") -> DataFrame:
    return df.filter(F.col(column) == word)


def split_pair(df: DataFrame, text: str = "value", failfast: bool = True) -> DataFrame:
    """``first, second``: the first two comma fields as strings."""
    parts = java_split(F.col(text), ",")
    pick = F.element_at if failfast else F.try_element_at
    return df.select("*", pick(parts, F.lit(1)).alias("first"), pick(parts, F.lit(2)).alias("second")).drop(text)


def parse_word_count(df: DataFrame, text: str = "value", failfast: bool = True) -> DataFrame:
    """``word, count`` from a ``word,count`` line; further fields are ignored.

    ``failfast`` stops the job on a short line or a non-number; otherwise the bad
    part becomes NULL.
    """
    pairs = split_pair(df, text, failfast)
    second = F.col("second")
    count = second.cast("bigint") if failfast else second.try_cast("bigint")
    return pairs.withColumn("count", count).withColumnRenamed("first", "word").drop("second")
