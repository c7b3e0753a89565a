"""Running word counts and maxima: batch forms emit a row per input row, stream forms update per key."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rillrank.operators.ordered import Skew
from rillrank.operators.ordered import running_max as _running_max
from rillrank.operators.ordered import running_sum as _running_sum


def running_count(words: DataFrame, order: str = "seq", word: str = "word", count: str = "cnt",
                  skew: Skew = Skew()) -> DataFrame:
    return _running_sum(words, [word], order, count, "total", skew)


def latest_count(words: DataFrame, word: str = "word", count: str = "cnt") -> DataFrame:
    """Total per key; as a stream in update mode, the new total of each key a batch touched."""
    return words.groupBy(word).agg(F.sum(count).alias("total"))


def running_largest(df: DataFrame, key: str = "word", order: str = "seq", value: str = "count",
                    skew: Skew = Skew()) -> DataFrame:
    return _running_max(df, [key], order, value, "largest", skew)


def latest_largest(df: DataFrame, key: str = "word", value: str = "count") -> DataFrame:
    return df.groupBy(key).agg(F.max(value).alias("largest"))
