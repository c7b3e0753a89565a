"""Named queries over the given tables, one or more per operator."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rillrank.functions import json_records, text
from rillrank.operators import alerts, counting, ordered, ranking, windows
from rillrank.plans import inputs, jobs

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


# Keys above this many rows are split, in the queries by event type: each type holds a
# fifth of all rows, however large the table.
SPLIT = ordered.Skew(chunk_rows=1000)


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inputs.table(spark, sf_dir, "events")


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inputs.table(spark, sf_dir, "documents")


# --- windows and top-N -------------------------------------------------------------

@query
def top_hosts_by_sessions(spark, sf_dir):
    return jobs.top_hosts(inputs.as_traffic(_events(spark, sf_dir)), "session_num", size="1 hour")


@query
def top_hosts_by_bytes(spark, sf_dir):
    return jobs.top_hosts(inputs.as_traffic(_events(spark, sf_dir)), "bytes", size="1 hour")


@query
def top_hosts_by_packets(spark, sf_dir):
    return jobs.top_hosts(inputs.as_traffic(_events(spark, sf_dir)), "packets", size="1 hour")


@query
def top_hosts_report(spark, sf_dir):
    return jobs.top_hosts_report(inputs.as_traffic(_events(spark, sf_dir)), size="1 hour")


@query
def top_hosts_report_with_time(spark, sf_dir):
    return jobs.top_hosts_report(
        inputs.as_traffic(_events(spark, sf_dir)), "bytes", size="1 hour", with_time=True
    )


@query
def top_hosts_flattened(spark, sf_dir):
    """Ranked rows nested to one list per window and flattened again."""
    ranked = jobs.top_hosts(inputs.as_traffic(_events(spark, sf_dir)), "packets", size="1 hour")
    return ranking.flatten_hosts(ranking.nest_hosts(ranked))


@query
def window_agg(spark, sf_dir):
    return jobs.host_windows(inputs.as_traffic(_events(spark, sf_dir)), size="1 hour")


@query
def two_metric_agg(spark, sf_dir):
    traffic = inputs.as_traffic(_events(spark, sf_dir))
    return windows.tumbling(traffic, "event_time", "1 hour", windows.TWO_METRICS, ["client_ip"])


@query
def word_top_n(spark, sf_dir):
    return jobs.word_top_n(inputs.as_lines(_events(spark, sf_dir)), "2 hours", "1 hour", "30 minutes")


@query
def json_window_count(spark, sf_dir):
    numbers = inputs.as_numbers(_events(spark, sf_dir))
    return jobs.json_window_count(numbers, "1 hour", key="k")


@query
def json_window_sum(spark, sf_dir):
    numbers = inputs.as_numbers(_events(spark, sf_dir))
    return windows.tumbling(numbers, "arrival_ts", "1 hour", {"total": ("sum", "k")}, ["event_type"])


@query
def sliding_sum(spark, sf_dir):
    words = text.pair_with_one(text.tokenise(inputs.as_lines(_events(spark, sf_dir)), "\\s"))
    return windows.sliding(words, "arrival_ts", "3 hours", "1 hour", {"cnt": ("sum", "cnt")}, ["word"])


@query
def sliding_sum_long(spark, sf_dir):
    """Many windows per row: reduced to panes first."""
    numbers = inputs.as_numbers(_events(spark, sf_dir))
    return windows.sliding(
        numbers, "arrival_ts", "24 hours", "1 hour",
        {"cnt": ("count", "1"), "total": ("sum", "k"), "largest": ("max", "k")}, ["event_type"],
    )


@query
def tumbling_all_reduce(spark, sf_dir):
    words = inputs.as_numbers(_events(spark, sf_dir)).withColumnsRenamed({"event_type": "word", "k": "cnt"})
    return windows.tumbling_all_reduce(words, "arrival_ts", "3 hours", "seq")


@query
def window_all_count(spark, sf_dir):
    return jobs.window_all_count(inputs.as_lines(_events(spark, sf_dir)), "1 hour")


@query
def session_sum(spark, sf_dir):
    numbers = inputs.as_numbers(_events(spark, sf_dir))
    return windows.sessions(
        numbers, "arrival_ts", "1 hour", {"cnt": ("count", "1"), "total": ("sum", "k")}, ["user_id"]
    )


@query
def count_window_all(spark, sf_dir):
    return windows.count_window_all(inputs.as_numbers(_events(spark, sf_dir)), "seq", 5, "k")


@query
def count_window_slide(spark, sf_dir):
    return windows.count_window_slide(inputs.as_numbers(_events(spark, sf_dir)), ["user_id"], "seq", 5, 2, "k")


# --- parsing and tokens ------------------------------------------------------------

@query
def json_parse_defaults(spark, sf_dir):
    """Records that lack most fields: the absent numbers are 0."""
    record = F.to_json(F.struct(
        F.col("user_id").cast("string").alias("client_ip"),
        inputs.number_of_props().alias("c2s_pkt_num"),
    ))
    lines = _events(spark, sf_dir).select("event_id", record.alias("value"))
    return jobs.traffic_of_lines(lines).rows.drop("event_time")


def _damaged(spark, sf_dir):
    line = F.when(F.col("event_type") == "error", F.substring("props", 1, 5)).otherwise(F.col("props"))
    return _events(spark, sf_dir).select("event_id", line.alias("value"))


@query
def json_rejects(spark, sf_dir):
    return json_records.parse_traffic(_damaged(spark, sf_dir)).rejects


@query
def renamed_traffic(spark, sf_dir):
    record = F.to_json(F.struct(
        F.col("user_id").cast("string").alias("client_ip"), F.unix_millis(F.col("ts").cast("timestamp")).alias("recv_time"),
    ))
    lines = _events(spark, sf_dir).select("event_id", record.alias("value"))
    return json_records.rename_traffic(json_records.parse_traffic(lines).rows)


@query
def student_records(spark, sf_dir):
    """Records with a name and a number, absent for one event type."""
    record = F.to_json(F.struct(
        F.col("event_type").alias("name"),
        F.when(F.col("event_type") != "view", inputs.number_of_props()).alias("age"),
    ))
    lines = _events(spark, sf_dir).select("event_id", record.alias("value"))
    return json_records.parse_students(lines).rows


@query
def word_count_lines(spark, sf_dir):
    lines = _events(spark, sf_dir).select(
        "event_id", F.concat_ws(",", "event_type", F.col("user_id").cast("string"), F.lit("rest")).alias("value")
    )
    return text.parse_word_count(lines)


@query
def line_pairs(spark, sf_dir):
    return text.split_pair(inputs.as_lines(_events(spark, sf_dir)).drop("arrival_ts"))


def _word_totals(words: DataFrame) -> DataFrame:
    return counting.latest_count(text.pair_with_one(words))


@query
def tokenise_lower_count(spark, sf_dir):
    return _word_totals(text.tokenise_lower(_documents(spark, sf_dir).select("text"), "text"))


@query
def tokenise_comma(spark, sf_dir):
    return _word_totals(text.tokenise(_documents(spark, sf_dir).select("text"), ",", "text"))


@query
def tokenise_space(spark, sf_dir):
    return _word_totals(text.tokenise(_documents(spark, sf_dir).select("text"), " ", "text"))


@query
def tokenise_ws(spark, sf_dir):
    return _word_totals(text.tokenise(_documents(spark, sf_dir).select("text"), "\\s", "text"))


@query
def tokens_per_document(spark, sf_dir):
    documents = _documents(spark, sf_dir)
    return documents.select(
        "doc_id",
        F.size(text.java_split(F.col("text"), ",")).cast("bigint").alias("by_comma"),
        F.size(text.java_split(F.col("text"), " ")).cast("bigint").alias("by_space"),
        F.size(text.java_split(F.col("text"), "\\s")).cast("bigint").alias("by_whitespace"),
        F.size(text.java_split(F.col("text"), "[.] ?")).cast("bigint").alias("by_stop"),
    )


@query
def append_suffix(spark, sf_dir):
    return inputs.as_lines(_events(spark, sf_dir)).select("seq", text.append_suffix(F.col("value")).alias("value"))


@query
def keep_word(spark, sf_dir):
    words = text.pair_with_one(text.tokenise(inputs.as_lines(_events(spark, sf_dir)).drop("arrival_ts"), ","))
    return text.keep_word(words, "click").withColumn("cnt", F.col("cnt").cast("bigint"))


# --- running aggregates and alerts -------------------------------------------------

@query
def running_word_count(spark, sf_dir):
    return jobs.running_word_count(inputs.as_lines(_events(spark, sf_dir)), "click")


@query
def running_sum(spark, sf_dir):
    numbers = inputs.as_numbers(_events(spark, sf_dir)).select("seq", "user_id", "k")
    return ordered.running_sum(numbers, ["user_id"], "seq", "k")


@query
def running_max(spark, sf_dir):
    return jobs.running_max(inputs.as_value_lines(_events(spark, sf_dir)))


@query
def latest_count(spark, sf_dir):
    return _word_totals(text.tokenise(inputs.as_lines(_events(spark, sf_dir)).select("value"), ","))


@query
def latest_largest(spark, sf_dir):
    return counting.latest_largest(text.parse_word_count(inputs.as_value_lines(_events(spark, sf_dir)).select("value")))


@query
def breach_flags(spark, sf_dir):
    return alerts.breach_flags(inputs.as_pairs(_events(spark, sf_dir)), keep=["seq"])


def unnest_alerts(found: DataFrame) -> DataFrame:
    rows = found.select("key", "alert_no", "last_seq", "message", F.posexplode("abnormal_values").alias("pos", "value"))
    return rows.withColumn("pos", F.col("pos").cast("bigint"))


@query
def threshold_alerts(spark, sf_dir):
    return unnest_alerts(jobs.threshold_alerts(inputs.as_pairs(_events(spark, sf_dir))))


# --- hot keys: the same operators with every key split into chunks -----------------

@query
def session_sum_by_type(spark, sf_dir):
    numbers = inputs.as_numbers(_events(spark, sf_dir))
    return windows.sessions(numbers, "arrival_ts", "5 minutes", {"total": ("sum", "k")}, ["event_type"], SPLIT)


@query
def running_sum_by_type(spark, sf_dir):
    numbers = inputs.as_numbers(_events(spark, sf_dir)).select("seq", "event_type", "k")
    return ordered.running_sum(numbers, ["event_type"], "seq", "k", skew=SPLIT)


@query
def running_max_by_type(spark, sf_dir):
    numbers = inputs.as_numbers(_events(spark, sf_dir)).select("seq", "event_type", "k")
    return ordered.running_max(numbers, ["event_type"], "seq", "k", skew=SPLIT)


@query
def threshold_alerts_by_type(spark, sf_dir):
    pairs = _events(spark, sf_dir).select(F.col("event_id").alias("seq"), F.col("event_type").alias("key"), "value")
    return unnest_alerts(alerts.threshold_alerts(pairs, 20, 7, skew=SPLIT))


@query
def count_window_slide_by_type(spark, sf_dir):
    numbers = inputs.as_numbers(_events(spark, sf_dir))
    return windows.count_window_slide(numbers, ["event_type"], "seq", 5, 2, "k", SPLIT)


@query
def count_window_all_split(spark, sf_dir):
    return windows.count_window_all(inputs.as_numbers(_events(spark, sf_dir)), "seq", 5, "k", SPLIT)
