"""The jobs, batch form: each takes input rows and returns result rows.

The stream forms are in ``rillrank.streaming``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rillrank import fixed
from rillrank.functions import json_records, text
from rillrank.operators import alerts, counting, ranking, windows
from rillrank.operators.ordered import Skew


def traffic_of_lines(lines: DataFrame, mode: str = "permissive", observe: str | None = None) -> json_records.Parsed:
    """JSON lines to keyed traffic rows with ``event_time``, and the unreadable lines."""
    parsed = json_records.parse_traffic(lines, mode=mode)
    rows = json_records.with_event_time(json_records.drop_keyless(parsed.rows, observe=observe))
    return json_records.Parsed(rows, parsed.rejects)


def host_windows(traffic: DataFrame, ts: str = "event_time", size: str = fixed.EVENT_WINDOW) -> DataFrame:
    return windows.tumbling(traffic, ts, size, windows.TRAFFIC_MEASURES, ["client_ip"])


def top_hosts(traffic: DataFrame, order_by: str = "session_num", n: int = fixed.TOP_N,
              size: str = fixed.EVENT_WINDOW, ts: str = "event_time") -> DataFrame:
    return ranking.top_hosts_of_windows(host_windows(traffic, ts, size), order_by, n)


def top_hosts_report(traffic: DataFrame, order_by: str = "session_num", n: int = fixed.TOP_N,
                     size: str = fixed.EVENT_WINDOW, ts: str = "event_time", with_time: bool = False) -> DataFrame:
    return ranking.render_report(top_hosts(traffic, order_by, n, size, ts), with_time)


def word_windows(lines: DataFrame, size: str = fixed.WORD_WINDOW, slide: str = fixed.WORD_SLIDE,
                 ts: str = "arrival_ts") -> DataFrame:
    words = text.pair_with_one(text.tokenise_lower(lines.select("value", ts)))
    return windows.sliding(words, ts, size, slide, {"cnt": ("sum", "cnt")}, ["word"])


def with_bucket(counts: DataFrame, bucket: str = fixed.WORD_BUCKET) -> DataFrame:
    """Adds the global window in which a closed word window is ranked.

    A result belongs to the last microsecond of its window, as in chained streaming
    aggregates; ``source_window_end`` tells the word windows apart.
    """
    moment = F.col("window_end") - F.expr("INTERVAL 1 microsecond")
    bucketed = counts.withColumn("_bucket", F.window(moment, bucket))
    return bucketed.select(
        F.col("_bucket.end").alias("bucket_end"), F.col("window_end").alias("source_window_end"), "word", "cnt"
    )


def word_top_n(lines: DataFrame, size: str = fixed.WORD_WINDOW, slide: str = fixed.WORD_SLIDE,
               bucket: str = fixed.WORD_BUCKET, n: int = fixed.TOP_N, ts: str = "arrival_ts") -> DataFrame:
    return rank_words(with_bucket(word_windows(lines, size, slide, ts), bucket), ["bucket_end"], n)


def rank_words(bucketed: DataFrame, groups: list[str], n: int) -> DataFrame:
    # Several word windows may share a bucket; their rows of one word stay separate.
    tie = F.struct(F.col("word"), F.col("source_window_end"))
    return ranking.top_n(bucketed.withColumn("_tie", tie), groups, F.col("cnt"), "_tie", n).drop("_tie")


def json_window_count(students: DataFrame, size: str = fixed.JSON_WINDOW, ts: str = "arrival_ts",
                      key: str = "name") -> DataFrame:
    return windows.tumbling(students, ts, size, {"cnt": ("count", "1")}, [key])


def running_word_count(lines: DataFrame, word: str = fixed.KEPT_WORD, order: str = "seq",
                       skew: Skew = Skew()) -> DataFrame:
    """One row per occurrence of ``word`` with its count so far.

    Several occurrences in a line follow each other: with ``order`` alone they would tie,
    so each line contributes its occurrences as one step that is then spelled out.
    """
    per_line = (
        lines.select(order, text.java_split(F.col("value"), ",").alias("_words"))
        .select(order, F.size(F.filter("_words", lambda w: w == word)).cast("bigint").alias("_n"))
        .filter(F.col("_n") > 0).withColumn("word", F.lit(word))
    )
    summed = counting.running_count(per_line, order, "word", "_n", skew)
    return summed.select(
        order, "word", F.explode(F.sequence(F.col("total") - F.col("_n") + 1, F.col("total"))).alias("total")
    )


def running_max(lines: DataFrame, order: str = "seq", failfast: bool = True, skew: Skew = Skew()) -> DataFrame:
    return counting.running_largest(text.parse_word_count(lines, failfast=failfast), order=order, skew=skew)


def window_all_count(lines: DataFrame, size: str = fixed.GLOBAL_WINDOW, ts: str = "arrival_ts") -> DataFrame:
    words = text.pair_with_one(text.tokenise(lines, " "))
    return windows.tumbling(words, ts, size, {"cnt": ("sum", "cnt")})


def breach_flags(pairs: DataFrame, threshold: float = fixed.ALERT_THRESHOLD) -> DataFrame:
    return alerts.breach_flags(pairs, threshold)


def threshold_alerts(pairs: DataFrame, threshold: float = fixed.ALERT_THRESHOLD, times: int = fixed.ALERT_TIMES,
                     skew: Skew = Skew()) -> DataFrame:
    return alerts.threshold_alerts(pairs, threshold, times, skew=skew)
