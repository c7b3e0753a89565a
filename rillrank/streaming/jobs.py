"""The jobs, stream form.

Each ``stream_*`` function starts a query that writes per-batch files under ``path``.
"""

from __future__ import annotations

from contextlib import nullcontext

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from rillrank import fixed
from rillrank.functions import text
from rillrank.operators import alerts, counting, ranking, windows
from rillrank.plans import jobs
from rillrank.streaming import carry, processors, sinks


def host_windows(traffic: DataFrame, size: str = fixed.EVENT_WINDOW, delay: str = fixed.WATERMARK_DELAY,
                 ts: str = "event_time") -> DataFrame:
    return jobs.host_windows(traffic.withWatermark(ts, delay), ts, size)


def stream_top_hosts(traffic: DataFrame, path: str, checkpoint: str, order_by: str = "session_num",
                     n: int = fixed.TOP_N, size: str = fixed.EVENT_WINDOW, delay: str = fixed.WATERMARK_DELAY,
                     ts: str = "event_time", report: bool = False,
                     every: str | None = fixed.CHECKPOINT_INTERVAL, show: bool = False) -> StreamingQuery:
    """Top hosts of each closed window, printed as well if ``show``.

    All hosts of a window are emitted in the batch in which the watermark passes its end,
    so ranking inside the batch sees the window whole; no state holds a window's hosts.
    """
    def shape(batch: DataFrame) -> DataFrame:
        ranked = ranking.top_hosts_of_windows(batch, order_by, n)
        return ranking.render_report(ranked) if report else ranked

    with sinks.single_operator(traffic.sparkSession):
        return sinks.start(host_windows(traffic, size, delay, ts), sinks.to_files(path, shape, show), checkpoint, every=every)


def stream_top_hosts_by_timer(traffic: DataFrame, path: str, checkpoint: str, order_by: str = "session_num",
                              n: int = fixed.TOP_N, size: str = fixed.EVENT_WINDOW,
                              delay: str = fixed.WATERMARK_DELAY, ts: str = "event_time",
                              parts: int | None = None,
                              every: str | None = fixed.CHECKPOINT_INTERVAL) -> StreamingQuery:
    """Top hosts of each window by a timer after the window's end, with at most ``n`` hosts
    per part of a window in state. ``stream_top_hosts`` gives the same ranks for less.

    By default a window has as many parts as let an eighth of the tasks share it.
    """
    if parts is None:
        parts = max(2, int(traffic.sparkSession.conf.get("spark.sql.shuffle.partitions")) // 8)
    counted = windows.aggregate_window(
        traffic.withWatermark(ts, delay), ts, size, windows.TRAFFIC_MEASURES, ["client_ip"]
    )
    columns = ["client_ip", *windows.TRAFFIC_MEASURES]
    best = processors.best_at_window_end(counted, n, ranking.ORDERS[order_by], "client_ip", columns, parts)

    def shape(batch: DataFrame) -> DataFrame:
        timed = batch.withColumn("window_end", F.timestamp_millis("window_end_ms")).drop("window_end_ms")
        return ranking.top_hosts_of_windows(timed, order_by, n)

    return sinks.start(best, sinks.to_files(path, shape), checkpoint, every=every)


def stream_word_top_n(lines: DataFrame, path: str, checkpoint: str, size: str = fixed.WORD_WINDOW,
                      slide: str = fixed.WORD_SLIDE, bucket: str = fixed.WORD_BUCKET, n: int = fixed.TOP_N,
                      delay: str = fixed.WATERMARK_DELAY, ts: str = "arrival_ts",
                      every: str | None = fixed.CHECKPOINT_INTERVAL, show: bool = False) -> StreamingQuery:
    """Top words of each closed word window, labelled with their bucket; printed as well if ``show``.

    ``bucket_top_n`` gives the final ranks. A bucket no longer than the slide holds one word
    window; a longer one holds several, and its top N are among theirs.
    """
    def shape(batch: DataFrame) -> DataFrame:
        return jobs.rank_words(jobs.with_bucket(batch, bucket), ["bucket_end", "source_window_end"], n)

    counts = jobs.word_windows(lines.withWatermark(ts, delay), size, slide, ts)
    # Panes and windows are two stateful operators.
    two = windows.in_panes(lines.sparkSession, size, slide)
    with nullcontext() if two else sinks.single_operator(lines.sparkSession):
        return sinks.start(counts, sinks.to_files(path, shape, show), checkpoint, every=every)


def bucket_top_n(candidates: DataFrame, n: int = fixed.TOP_N) -> DataFrame:
    return jobs.rank_words(candidates.drop("rank", sinks.BATCH), ["bucket_end"], n)


def stream_sliding(df: DataFrame, path: str, checkpoint: str, size: str, slide: str, measures: windows.Measures,
                   keys: list[str], delay: str = fixed.WATERMARK_DELAY, ts: str = "arrival_ts",
                   every: str | None = fixed.CHECKPOINT_INTERVAL) -> StreamingQuery:
    """Sliding aggregates; with many windows per row, from panes."""
    found = windows.sliding(df.withWatermark(ts, delay), ts, size, slide, measures, keys)
    return sinks.start(found, sinks.to_files(path), checkpoint, every=every)


def stream_json_window_count(students: DataFrame, path: str, checkpoint: str, size: str = fixed.JSON_WINDOW,
                             delay: str = fixed.WATERMARK_DELAY, ts: str = "arrival_ts", key: str = "name",
                             every: str | None = fixed.CHECKPOINT_INTERVAL) -> StreamingQuery:
    counts = jobs.json_window_count(students.withWatermark(ts, delay), size, ts, key)
    return sinks.start(counts, sinks.to_files(path), checkpoint, every=every)


def stream_window_all_count(lines: DataFrame, path: str, checkpoint: str, size: str = fixed.GLOBAL_WINDOW,
                            delay: str = fixed.WATERMARK_DELAY, ts: str = "arrival_ts",
                            every: str | None = fixed.CHECKPOINT_INTERVAL) -> StreamingQuery:
    counts = jobs.window_all_count(lines.withWatermark(ts, delay), size, ts)
    return sinks.start(counts, sinks.to_files(path), checkpoint, every=every)


def stream_sessions(df: DataFrame, path: str, checkpoint: str, gap: str, measures: windows.Measures,
                    keys: list[str], delay: str = fixed.WATERMARK_DELAY, ts: str = "arrival_ts",
                    every: str | None = fixed.CHECKPOINT_INTERVAL) -> StreamingQuery:
    found = windows.sessions(df.withWatermark(ts, delay), ts, gap, measures, keys)
    with sinks.merge_sessions_early(df.sparkSession):
        return sinks.start(found, sinks.to_files(path), checkpoint, every=every)


def stream_word_count(lines: DataFrame, path: str, checkpoint: str, word: str | None = fixed.KEPT_WORD,
                      every: str | None = fixed.CHECKPOINT_INTERVAL) -> StreamingQuery:
    """The new total of each word a batch touched; ``word=None`` counts all words."""
    words = text.pair_with_one(text.tokenise(lines.select("value"), ","))
    if word is not None:
        words = text.keep_word(words, word)
    return sinks.start(counting.latest_count(words), sinks.to_files(path), checkpoint, "update", every)


def stream_running_max(lines: DataFrame, path: str, checkpoint: str, failfast: bool = True,
                       every: str | None = fixed.CHECKPOINT_INTERVAL) -> StreamingQuery:
    largest = counting.latest_largest(text.parse_word_count(lines.select("value"), failfast=failfast))
    return sinks.start(largest, sinks.to_files(path), checkpoint, "update", every)


def stream_record_counts(lines: DataFrame, path: str, carried: str, checkpoint: str, word: str | None = fixed.KEPT_WORD,
                         keep: list[str] | None = None, every: str | None = fixed.CHECKPOINT_INTERVAL) -> StreamingQuery:
    """A row per occurrence of ``word`` (of any word if None) with its count so far, in the order of ``place``.

    A word that a line repeats follows itself. ``seq`` numbers the records of a batch; ``keep`` names columns of
    the lines to carry along.
    """
    fields = text.java_split(F.col("value"), ",")
    words = lines.select("place", *(keep or []), F.explode(fields).alias("word")).withColumn(
        "cnt", F.lit(1).cast("bigint"))
    if word is not None:
        words = text.keep_word(words, word)
    return carry.start(words, carry.running_sum(["word"], "seq", "cnt"), "seq", path, carried, checkpoint, every=every,
                       place="place")


def stream_record_maxima(lines: DataFrame, path: str, carried: str, checkpoint: str, failfast: bool = True,
                         keep: list[str] | None = None, every: str | None = fixed.CHECKPOINT_INTERVAL) -> StreamingQuery:
    """A row per ``word,count`` line with the word's largest count so far, in the order of ``place``."""
    pairs = text.parse_word_count(lines.select("place", *(keep or []), "value"), failfast=failfast)
    return carry.start(pairs, carry.running_max(["word"], "seq", "count"), "seq", path, carried, checkpoint, every=every,
                       place="place")


def stream_breach_flags(pairs: DataFrame, path: str, checkpoint: str, threshold: float = fixed.ALERT_THRESHOLD,
                        keep: list[str] | None = None,
                        every: str | None = fixed.CHECKPOINT_INTERVAL) -> StreamingQuery:
    return sinks.start(alerts.breach_flags(pairs, threshold, keep=keep), sinks.to_files(path), checkpoint, every=every)
