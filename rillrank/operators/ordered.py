"""Per-key computations in row order that survive hot keys.

A window partitioned by the key puts a whole key into one task. Where a key has more than ``chunk_rows``
rows, running aggregates and sliding sums go through the prefix scan of ``operators.scan`` instead: rows are
dealt by ranges of (key, order), whatever the sizes of the keys. Below that the plain window is used, which
needs one shuffle and no table. Sessions cut hot keys into chunks of their order column
(``chunk_hot_keys``).

The order column must be integral and unique per key; rows of equal order would have
no defined sequence in any engine.

Sums of integers and decimals are exact. Sums of floating values always go through the scan, which adds
without rounding, so that totals are the same however a key is split; NaN and infinities do what they do in any sum.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rillrank.operators.scan import Asked, scan, with_earlier

CHUNK = "_chunk"
HOT = "_hot"
_ALL = "_all"


@dataclass(frozen=True)
class Skew:
    """Limits of the hot-key handling.

    chunk_rows: a key with more rows is split.
    max_hot_keys: of sessions: the list of hot keys is broadcast up to this length; beyond it every
        key is chunked, which needs no list.
    """

    chunk_rows: int = 5_000_000
    max_hot_keys: int = 10_000


@dataclass(frozen=True)
class Chunked:
    rows: DataFrame
    keys: list[str]
    split: bool

    @property
    def groups(self) -> list[str]:
        return [*self.keys, CHUNK]


def chunk_hot_keys(df: DataFrame, keys: list[str], order: str, skew: Skew = Skew()) -> Chunked:
    """Adds ``_chunk`` and ``_hot``. Runs one count per key; quantiles only if a key is hot."""
    if not keys:
        df, keys = df.withColumn(_ALL, F.lit(0)), [_ALL]
    sizes = df.groupBy(*keys).agg(F.count("*").alias("_n")).filter(F.col("_n") > skew.chunk_rows)
    # At most max_hot_keys + 1 rows reach the driver.
    hot = sizes.limit(skew.max_hot_keys + 1).collect()
    if not hot:
        return Chunked(df.withColumns({CHUNK: F.lit(0), HOT: F.lit(False)}), keys, False)

    if len(hot) > skew.max_hot_keys:
        tagged, total = df.withColumn(HOT, F.lit(True)), df.count()
    else:
        names = df.sparkSession.createDataFrame(hot, sizes.schema).drop("_n").withColumn(HOT, F.lit(True))
        renamed = names.select(*[F.col(k).alias(f"_h_{k}") for k in keys], HOT)
        same = _same({k: f"_h_{k}" for k in keys})
        tagged = (
            df.join(F.broadcast(renamed), same, "left")
            .drop(*[f"_h_{k}" for k in keys])
            .withColumn(HOT, F.coalesce(HOT, F.lit(False)))
        )
        total = sum(row["_n"] for row in hot)

    chunk = _chunk_of(tagged.filter(HOT), order, total, skew.chunk_rows)
    rows = tagged.withColumn(CHUNK, F.when(F.col(HOT), chunk).otherwise(0))
    return Chunked(rows, keys, True)


def _same(pairs: dict[str, str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(left).eqNullSafe(F.col(right)) for left, right in pairs.items()])


_SEGMENTS = 128
_FAN = 64


def _chunk_of(hot: DataFrame, order: str, total: int, chunk_rows: int) -> Column:
    """Chunk number of a row.

    Quantiles cut the order column into up to 128 segments of equal row count (a balanced
    CASE tree, 7 comparisons per row); each is cut evenly by value into up to 64.
    """
    wanted = math.ceil(total / chunk_rows)
    n_segments = min(_SEGMENTS, max(2, wanted))
    fan = min(_FAN, max(1, math.ceil(wanted / n_segments)))
    probabilities = [i / n_segments for i in range(n_segments + 1)]
    cuts = hot.agg(F.percentile_approx(order, probabilities, 10_000).alias("cuts")).first()["cuts"]
    bounds = sorted(set(cuts))
    if len(bounds) < 2:
        return F.lit(0)
    inner = bounds[1:-1]
    x = F.col(order).cast("bigint")
    segment = _search(x, inner, 0)
    if fan == 1:
        return segment
    low = F.element_at(F.array(*[F.lit(b).cast("bigint") for b in bounds[:-1]]), segment + 1)
    width = F.element_at(
        F.array(*[F.lit(max(1, b - a)).cast("bigint") for a, b in zip(bounds, bounds[1:])]), segment + 1
    )
    # Rows outside the sampled range fall into the first or last piece.
    piece = F.greatest(F.lit(0), F.least(F.lit(fan - 1), F.floor((x - low) / width * fan).cast("int")))
    return segment * fan + piece


def _search(x: Column, bounds: list[int], first: int) -> Column:
    """Number of ``bounds`` at or below ``x``, plus ``first``."""
    if not bounds:
        return F.lit(first)
    mid = len(bounds) // 2
    return F.when(x < F.lit(bounds[mid]), _search(x, bounds[:mid], first)).otherwise(
        _search(x, bounds[mid + 1:], first + mid + 1)
    )


@dataclass(frozen=True)
class Measure:
    """A running aggregate: its kind in a scan and its window aggregate."""

    kind: str
    aggregate: Callable[[Column], Column]


SUM = Measure("sum", F.sum)
MAX = Measure("max", F.max)
COUNT = Measure("count", F.count)


def has_hot_key(df: DataFrame, keys: list[str], skew: Skew) -> bool:
    """Whether a key, or without keys the table, has more rows than one task should get. One count per key."""
    return not df.groupBy(*keys).agg(F.count("*").alias("_n")).filter(F.col("_n") > skew.chunk_rows).isEmpty()


def running(df: DataFrame, keys: list[str], order: str,
            measures: dict[str, tuple[Measure, Column]], skew: Skew = Skew()) -> DataFrame:
    """Each row with the aggregates of its key up to and including itself."""
    if not (_float_sums(df, measures) or has_hot_key(df, keys, skew)):
        here = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
        return df.withColumns({n: m.aggregate(c).over(here) for n, (m, c) in measures.items()})
    asked = [Asked(n, m.kind, c) for n, (m, c) in measures.items()]
    rows = with_earlier(scan(df, keys, order, asked), asked)
    return rows.select(*[F.col(f"`{c}`") for c in df.columns], *measures)


def _float_sums(rows: DataFrame, measures: dict[str, tuple[Measure, Column]]) -> bool:
    """Whether a sum of floating values is asked for: in a window it would depend on how rows are grouped."""
    return any(m is SUM and isinstance(rows.select(c).schema[0].dataType, (T.DoubleType, T.FloatType))
               for m, c in measures.values())


def running_sum(df: DataFrame, keys: list[str], order: str, value: str, out: str = "total",
                skew: Skew = Skew()) -> DataFrame:
    return running(df, keys, order, {out: (SUM, F.col(value))}, skew)


def running_max(df: DataFrame, keys: list[str], order: str, value: str, out: str = "largest",
                skew: Skew = Skew()) -> DataFrame:
    return running(df, keys, order, {out: (MAX, F.col(value))}, skew)


def number_rows(df: DataFrame, keys: list[str], order: str, out: str = "row_no",
                skew: Skew = Skew()) -> DataFrame:
    """1-based position of each row in its key; without keys, in the whole table."""
    return running(df, keys, order, {out: (COUNT, F.lit(1))}, skew)


def consecutive_groups(df: DataFrame, keys: list[str], order: str, size: int, skew: Skew = Skew()) -> DataFrame:
    """Adds each row's position ``_no`` in its key and ``_group``, the 0-based run of ``size`` rows it is in."""
    numbered = number_rows(df, keys, order, "_no", skew)
    return numbered.withColumn("_group", F.floor((F.col("_no") - 1) / size).cast("bigint"))


def values_in_order(value: str) -> Column:
    """Aggregate of a group of ``consecutive_groups``: its values by position."""
    return F.transform(F.sort_array(F.collect_list(F.struct("_no", value))), lambda r: r[value])
