"""Time-window aggregation: tumbling, sliding, session, keyed or global.

All forms work on batch and streaming DataFrames except where said. Results carry
``window_start`` and ``window_end`` as plain columns.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampNTZType

from rillrank.operators.ordered import CHUNK, HOT, Skew, chunk_hot_keys, consecutive_groups, has_hot_key
from rillrank.operators.scan import Asked, scan, slide_over_parts, with_earlier

# name of the result -> (aggregate, input expression). An aggregate is "count", "sum", "max" or "min":
# those whose partial results can be aggregated again.
Measures = dict[str, tuple[str, str]]

_FIRST = {"count": F.count, "sum": F.sum, "max": F.max, "min": F.min}
_AGAIN = {**_FIRST, "count": F.sum}

TRAFFIC_MEASURES: Measures = {
    "session_num": ("count", "1"),
    "c2s_pkt_num": ("sum", "c2s_pkt_num"),
    "s2c_pkt_num": ("sum", "s2c_pkt_num"),
    "c2s_byte_num": ("sum", "c2s_byte_num"),
    "s2c_byte_num": ("sum", "s2c_byte_num"),
}

TWO_METRICS: Measures = {
    "session_num": ("count", "1"),
    "pkt_num": ("sum", "c2s_pkt_num + s2c_pkt_num"),
    "byte_num": ("sum", "c2s_byte_num + s2c_byte_num"),
}


def _first(measures: Measures) -> list[Column]:
    return [_FIRST[kind](F.expr(value)).alias(name) for name, (kind, value) in measures.items()]


def _again(measures: Measures) -> list[Column]:
    return [_AGAIN[kind](F.col(name)).alias(name) for name, (kind, _) in measures.items()]


def plain_window(df: DataFrame, column: str = "window") -> DataFrame:
    """``window_start, window_end`` in place of the window struct."""
    rest = [c for c in df.columns if c != column]
    return df.select(
        F.col(f"{column}.start").alias("window_start"), F.col(f"{column}.end").alias("window_end"), *rest
    )


def end_millis(window_end: Column) -> Column:
    """Epoch milliseconds of a window end, for TIMESTAMP and TIMESTAMP_NTZ (read in the session zone, UTC here)."""
    return F.unix_millis(window_end.cast("timestamp"))


def aggregate_window(df: DataFrame, ts: str, size: str, measures: Measures,
                     keys: list[str] | None = None, slide: str | None = None) -> DataFrame:
    """The windowed aggregate with its ``window`` struct (which keeps a stream's watermark)."""
    window = F.window(ts, size, slide) if slide else F.window(ts, size)
    return df.groupBy(window.alias("window"), *(keys or [])).agg(*_first(measures))


def tumbling(df: DataFrame, ts: str, size: str, measures: Measures, keys: list[str] | None = None) -> DataFrame:
    """Epoch-aligned windows. Aggregated on the map side first, so a hot key shuffles one
    row per input task and window."""
    return plain_window(aggregate_window(df, ts, size, measures, keys))


def sliding(df: DataFrame, ts: str, size: str, slide: str, measures: Measures,
            keys: list[str] | None = None, panes_from: int = 8) -> DataFrame:
    """Overlapping windows.

    Each row belongs to size/slide windows. From ``panes_from`` windows per row on, rows are
    first reduced to one per slide and key, so that the copies are made of reduced rows and not of the
    input. A stream does this in two chained aggregates: a pane is out once the watermark has passed it.
    """
    if not in_panes(df.sparkSession, size, slide, panes_from):
        return plain_window(aggregate_window(df, ts, size, measures, keys, slide))
    keys = keys or []
    panes = aggregate_window(df, ts, slide, measures, keys)
    if df.isStreaming:
        # The time of a pane is its last microsecond, which lies in the windows that hold the pane.
        window = F.window(F.window_time("window"), size, slide).alias("window")
        return plain_window(panes.groupBy(window, *keys).agg(*_again(measures)))
    panes = panes.withColumn("_pane", F.col("window.start")).drop("window")
    window = F.window("_pane", size, slide).alias("window")
    return plain_window(panes.groupBy(window, *keys).agg(*_again(measures)))


def in_panes(spark: SparkSession, size: str, slide: str, panes_from: int = 8) -> bool:
    """Whether sliding windows are computed from panes: each row in many windows, which are whole panes."""
    overlap = _micros(spark, size) / _micros(spark, slide)
    return overlap >= panes_from and overlap.is_integer()


def _micros(spark: SparkSession, duration: str) -> int:
    """Microseconds of any duration that a window accepts, as Spark reads it."""
    epoch = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"
    return spark.sql(f"SELECT {_interval_micros(f'{epoch} + INTERVAL {duration}')} AS us").first()["us"]


def _interval_micros(ts: str) -> str:
    """Microseconds from 1970 of a TIMESTAMP_NTZ expression, without any time zone."""
    return f"timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', {ts})"


def tumbling_all_reduce(df: DataFrame, ts: str, size: str, seq: str, word: str = "word",
                        count: str = "cnt") -> DataFrame:
    """Global windows: the word that came first and the sum of all counts.

    "Word of the smallest seq" has no hash aggregate, so a batch is first reduced by word
    with one; only a row per window and word is sorted.
    """
    window = F.window(ts, size).alias("window")
    if not df.isStreaming:
        df = df.groupBy(window, word).agg(F.min(seq).alias(seq), F.sum(count).alias(count))
        window = F.col("window")
    return plain_window(df.groupBy(window).agg(F.min_by(word, seq).alias(word), F.sum(count).alias(count)))


def sessions(df: DataFrame, ts: str, gap: str, measures: Measures, keys: list[str],
             skew: Skew = Skew()) -> DataFrame:
    """Session windows per key; rows at most ``gap`` apart share one. The end is last row + gap."""
    if df.isStreaming:
        return _session_window(df, ts, gap, measures, keys)
    micros = "_ts_us"
    # Like session_window, rows without a time are in no session.
    timed = df.where(F.col(ts).isNotNull())
    wall_clock = isinstance(df.schema[ts].dataType, TimestampNTZType)
    timed = timed.withColumn(micros, F.expr(_interval_micros(f"`{ts}`")) if wall_clock else F.unix_micros(ts))
    chunked = chunk_hot_keys(timed, keys, micros, skew)
    if not chunked.split:
        return _session_window(df, ts, gap, measures, keys)

    # Sessions inside each chunk; only the first and last of a chunk can go on in another.
    gap_us = _micros(df.sparkSession, gap)
    local = _islands(chunked.rows, chunked.groups, micros, micros, gap_us)
    pieces = local.groupBy(*chunked.groups, HOT, "_island").agg(
        F.min(ts).alias("_start"), F.max(ts).alias("_last"),
        F.min(micros).alias("_start_us"), F.max(micros).alias("_last_us"), *_first(measures),
    )
    last = F.max("_island").over(Window.partitionBy(*chunked.groups))
    edge = F.col(HOT) & ((F.col("_island") == 1) | (F.col("_island") == last))
    # Edges of a key meet in slot -1, at most two per chunk; the others stay by chunk, where
    # each is its own session.
    slotted = pieces.withColumn("_slot", F.when(edge, -1).otherwise(F.col(CHUNK))).drop("_island")
    groups = [*chunked.keys, "_slot"]
    return (
        _islands(slotted, groups, "_start_us", "_last_us", gap_us)
        .groupBy(*groups, "_island")
        .agg(F.min("_start").alias("_start"), F.max("_last").alias("_last"), *_again(measures))
        .select(
            F.col("_start").alias("window_start"),
            (F.col("_last") + F.expr(f"INTERVAL {gap}")).alias("window_end"),
            *keys, *measures,
        )
    )


def _session_window(df: DataFrame, ts: str, gap: str, measures: Measures, keys: list[str]) -> DataFrame:
    window = F.session_window(ts, gap).alias("window")
    return plain_window(df.groupBy(window, *keys).agg(*_first(measures)))


def _islands(df: DataFrame, groups: list[str], start: str, end: str, gap_us: int) -> DataFrame:
    """Numbers runs of rows that start at most the gap after the row before them ends."""
    ordered = Window.partitionBy(*groups).orderBy(start)
    opens = F.coalesce(F.col(start) - F.lag(end).over(ordered) > gap_us, F.lit(True)).cast("int")
    return df.withColumn("_opens", opens).withColumn(
        "_island", F.sum("_opens").over(ordered.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    ).drop("_opens")


def count_window_all(df: DataFrame, order: str, size: int, value: str, skew: Skew = Skew()) -> DataFrame:
    """Sums of every ``size`` consecutive rows of the whole table; a short tail gives nothing."""
    return (
        consecutive_groups(df, [], order, size, skew).groupBy(F.col("_group").alias("window_no"))
        .agg(F.max(order).alias("last_seq"), F.sum(value).alias("total"), F.count("*").alias("_n"))
        .filter(F.col("_n") == size).drop("_n")
    )


def count_window_slide(df: DataFrame, keys: list[str], order: str, size: int, slide: int, value: str,
                       skew: Skew = Skew(), carried: str | None = None) -> DataFrame:
    """At every ``slide``-th row of a key, the sum of its last ``size`` rows (fewer at the start).

    Firings at rows marked in the ``carried`` column are left out.
    """
    old = F.col(carried) if carried else F.lit(False)
    rows = df.select(*keys, F.col(order).alias("_seq"), F.col(value).alias("_value"), old.alias("_old"))
    fired = (F.col("_no") % slide == 0) & ~F.col("_old")
    if not has_hot_key(rows, keys, skew):
        whole = Window.partitionBy(*keys).orderBy("_seq")
        totals = rows.withColumns({
            "_no": F.count(F.lit(1)).over(whole.rowsBetween(Window.unboundedPreceding, Window.currentRow)),
            "total": F.sum("_value").over(whole.rowsBetween(1 - size, Window.currentRow)),
        })
    else:
        # Windows reach over partitions only in the first rows of a partition's first run.
        asked = [Asked("_no", "count", F.lit(1)), Asked("total", "slide", F.col("_value"), size)]
        scanned = scan(rows, keys, "_seq", asked)
        summed = replace(scanned, rows=slide_over_parts(scanned, "total", "_value", size))
        totals = with_earlier(summed, asked)
    return totals.filter(fired).select(*keys, F.col("_no").alias("fired_at"), F.col("_seq").alias("last_seq"), "total")
