"""Named queries that replay the given tables as streams and return what the stream wrote.

A table is taken in as several triggers, in the order of its times or of its row numbers (`sources.replay`),
so that watermarks move, windows close and state is evicted while the stream runs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rillrank.plans import inputs
from rillrank.plans.table_queries import unnest_alerts
from rillrank.session import STATE_STORE, run_dir
from rillrank.sources import replay as replays
from rillrank.streaming import carry, jobs, processors, sinks

QUERIES = {}
STEPS = 4


def _replayed(order: str):
    """The steps of the events in the order of a column."""
    return lambda spark, path: replays.replay_of(spark, path, order, STEPS)


def replay(steps):
    """Registers ``fn(events, out, checkpoint, carried)``, which starts a query over one step and returns it
    with a function of all written rows. ``steps`` gives the replay of the events."""
    def register(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            base = run_dir(spark, fn.__name__)
            finish = None

            def start(events: DataFrame):
                nonlocal finish
                # Watermarks need an instant, not a wall-clock time.
                timed = events.withColumn("ts", F.col("ts").cast("timestamp"))
                started, finish = fn(timed, f"{base}/out", f"{base}/checkpoint", f"{base}/carry")
                return started

            with sinks.session_settings(spark, STATE_STORE):
                replays.run(steps(spark, f"{sf_dir}/events.parquet"), spark, start)
            return finish(sinks.read_batches(spark, f"{base}/out"))

        QUERIES[fn.__name__] = run
        return run
    return register


by_time, by_number = replay(_replayed("ts")), replay(_replayed("event_id"))


def _plain(written: DataFrame) -> DataFrame:
    return written.drop(sinks.BATCH)


def _wall_clock(written: DataFrame) -> DataFrame:
    """Window bounds as TIMESTAMP_NTZ, like those of the batch queries."""
    bounds = [c for c in ("window_start", "window_end", "bucket_end", "source_window_end") if c in written.columns]
    return _plain(written).withColumns({c: F.col(c).cast("timestamp_ntz") for c in bounds})


@by_time
def stream_top_hosts(events, out, checkpoint, _):
    traffic = inputs.as_traffic(events)
    return jobs.stream_top_hosts(traffic, out, checkpoint, size="1 hour", every=None), _plain


@by_time
def stream_top_hosts_report(events, out, checkpoint, _):
    traffic = inputs.as_traffic(events)
    return jobs.stream_top_hosts(
        traffic, out, checkpoint, "packets", size="1 hour", report=True, every=None
    ), _plain


@by_time
def stream_top_hosts_by_timer(events, out, checkpoint, _):
    """The same ranks through state and event-time timers."""
    traffic = inputs.as_traffic(events)
    return jobs.stream_top_hosts_by_timer(traffic, out, checkpoint, size="1 hour", every=None), _plain


def _arrivals(spark: SparkSession, path: str) -> replays.Replay:
    """Every seventh event arrives a step after its neighbours, so that its window may be closed by then."""
    events = spark.read.parquet(path)
    n = (events.agg(F.max("event_id")).first()[0] or 0) + 1
    own = F.floor(F.col("event_id") * STEPS / n)
    return replays.copy_by_step(events, (own + F.when(F.col("event_id") % 7 == 3, 1).otherwise(0)).cast("int"))


@replay(_arrivals)
def stream_top_hosts_late(events, out, checkpoint, _):
    """Rows behind the watermark are dropped: they are in no rank and no total."""
    return jobs.stream_top_hosts(inputs.as_traffic(events), out, checkpoint, size="1 hour", every=None), _plain


@by_time
def stream_word_top_n(events, out, checkpoint, _):
    lines = inputs.as_lines(events)
    started = jobs.stream_word_top_n(lines, out, checkpoint, "2 hours", "1 hour", "30 minutes", every=None)
    return started, lambda written: _wall_clock(jobs.bucket_top_n(written))


@by_time
def stream_sliding_long(events, out, checkpoint, _):
    """Twelve windows per row: panes of an hour first, then windows of panes."""
    numbers = inputs.as_numbers(events)
    measures = {"cnt": ("count", "1"), "total": ("sum", "k"), "largest": ("max", "k")}
    return jobs.stream_sliding(numbers, out, checkpoint, "12 hours", "1 hour", measures, ["event_type"], every=None), _wall_clock


@by_time
def stream_json_window_count(events, out, checkpoint, _):
    numbers = inputs.as_numbers(events)
    return jobs.stream_json_window_count(numbers, out, checkpoint, "1 hour", key="k", every=None), _wall_clock


@by_time
def stream_window_all_count(events, out, checkpoint, _):
    lines = inputs.as_lines(events)
    return jobs.stream_window_all_count(lines, out, checkpoint, "1 hour", every=None), _wall_clock


@by_time
def stream_session_sum(events, out, checkpoint, _):
    numbers = inputs.as_numbers(events)
    measures = {"cnt": ("count", "1"), "total": ("sum", "k")}
    return jobs.stream_sessions(numbers, out, checkpoint, "1 hour", measures, ["user_id"], every=None), _wall_clock


@by_number
def stream_word_count(events, out, checkpoint, _):
    lines = inputs.as_lines(events)
    started = jobs.stream_word_count(lines, out, checkpoint, word=None, every=None)
    return started, lambda written: sinks.latest_updates(written, ["word"])


@by_number
def stream_running_max(events, out, checkpoint, _):
    lines = inputs.as_value_lines(events)
    started = jobs.stream_running_max(lines, out, checkpoint, every=None)
    return started, lambda written: sinks.latest_updates(written, ["word"])


def _placed(lines: DataFrame) -> DataFrame:
    """Table lines with their number as place, which is kept as ``line``."""
    return lines.select(F.struct("seq").alias("place"), F.col("seq").alias("line"), "value")


@by_number
def stream_record_counts(events, out, checkpoint, carried):
    """Every occurrence of every word with its count so far."""
    lines = _placed(inputs.as_lines(events))
    started = jobs.stream_record_counts(lines, out, carried, checkpoint, word=None, keep=["line"], every=None)
    return started, lambda written: _plain(written).select("line", "word", "total")


@by_number
def stream_record_maxima(events, out, checkpoint, carried):
    lines = _placed(inputs.as_value_lines(events))
    started = jobs.stream_record_maxima(lines, out, carried, checkpoint, keep=["line"], every=None)
    return started, lambda written: _plain(written).select("line", "word", "count", "largest")


@by_number
def stream_breach_flags(events, out, checkpoint, _):
    pairs = inputs.as_pairs(events)
    return jobs.stream_breach_flags(pairs, out, checkpoint, keep=["seq"], every=None), _plain


def _unnest(written: DataFrame) -> DataFrame:
    return unnest_alerts(written.withColumn("alert_no", F.lit(0))).drop("alert_no")


@by_number
def stream_threshold_alerts(events, out, checkpoint, _):
    pairs = inputs.as_pairs(events)
    found = processors.threshold_alerts(pairs)
    return sinks.start(found, sinks.to_alert_files(out), checkpoint, every=None), _unnest


@by_number
def stream_count_window_slide(events, out, checkpoint, _):
    numbers = inputs.as_numbers(events)
    sums = processors.count_window_slide(numbers, "user_id", "seq", 5, 2, "k")
    return sinks.start(sums, sinks.to_files(out), checkpoint, every=None), _plain


@by_number
def batched_threshold_alerts(events, out, checkpoint, carried):
    pairs = inputs.as_pairs(events)
    return carry.start(pairs, carry.threshold_alerts(), "seq", out, carried, checkpoint, every=None, persist=False), _unnest


@by_number
def batched_count_window_all(events, out, checkpoint, carried):
    numbers = inputs.as_numbers(events).select("seq", "k")
    return carry.start(
        numbers, carry.count_window_all("seq", 5, "k"), "seq", out, carried, checkpoint, every=None, persist=False
    ), _plain


@by_number
def batched_count_window_slide(events, out, checkpoint, carried):
    numbers = inputs.as_numbers(events).select("seq", "user_id", "k")
    return carry.start(
        numbers, carry.count_window_slide(["user_id"], "seq", 5, 2, "k"), "seq", out, carried, checkpoint, every=None, persist=False
    ), _plain


@by_number
def batched_running_sum(events, out, checkpoint, carried):
    numbers = inputs.as_numbers(events).select("seq", "user_id", "k")
    return carry.start(
        numbers, carry.running_sum(["user_id"], "seq", "k"), "seq", out, carried, checkpoint, every=None, persist=False
    ), _plain


@by_number
def batched_running_max(events, out, checkpoint, carried):
    numbers = inputs.as_numbers(events).select("seq", "user_id", "k")
    return carry.start(
        numbers, carry.running_max(["user_id"], "seq", "k"), "seq", out, carried, checkpoint, every=None, persist=False
    ), _plain
