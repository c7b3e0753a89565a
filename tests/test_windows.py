from __future__ import annotations

from pyspark.sql import functions as F

from rillrank.operators import windows
from rillrank.operators.alerts import breach_flags, threshold_alerts
from rillrank.operators.ordered import running_max
from rillrank.plans import jobs


def timed(spark, rows, schema="ms bigint, key string, n bigint"):
    return spark.createDataFrame(rows, schema).withColumn("ts", F.timestamp_millis("ms"))


def bounds(df):
    return df.withColumns({c: F.unix_millis(c) for c in ("window_start", "window_end")})


def test_threshold_alerts_on_the_pairs(pairs):
    got = threshold_alerts(pairs).orderBy("key", "alert_no").collect()
    assert [(r.key, r.abnormal_values) for r in got] == [
        ("a", [400, 100, 200]), ("b", [100, 200, 200]), ("b", [500, 600, 700])]
    assert got[0].message == "a 超过指定阈值 "


def test_breaches_are_strictly_above(pairs):
    got = breach_flags(pairs).collect()
    assert len(got) == 8 and {r.message for r in got} == {"dsadsad"}


def test_running_max_on_the_pairs(pairs):
    got = running_max(pairs, ["key"], "seq", "value").orderBy("seq").collect()
    assert [r.largest for r in got] == [50, 80, 400, 400, 400, 400, 100, 200, 200, 500, 600, 700]


def test_count_windows_on_the_pairs(pairs):
    got = windows.count_window_slide(pairs, ["key"], "seq", 5, 2, "value").orderBy("key", "fired_at").collect()
    assert [(r.key, r.fired_at, r.total) for r in got] == [
        ("a", 2, 130), ("a", 4, 630), ("a", 6, 980), ("b", 2, 300), ("b", 4, 1000), ("b", 6, 2200)]
    got = windows.count_window_all(pairs, "seq", 5, "value").orderBy("window_no").collect()
    assert [r.total for r in got] == [830, 1200]


def test_alert_times_of_one(pairs):
    assert threshold_alerts(pairs, times=1).count() == 10


def test_tumbling_counts_records_not_the_session_field(spark):
    df = timed(spark, [(0, "x", 9), (4999, "x", 9), (5000, "x", 9)])
    got = bounds(windows.tumbling(df, "ts", "5 seconds", {"c": ("count", "1"), "s": ("sum", "n")}, ["key"]))
    assert sorted((r.window_start, r.window_end, r.c, r.s) for r in got.collect()) == [(0, 5000, 2, 18), (5000, 10000, 1, 9)]


def test_int_sums_do_not_wrap(spark):
    df = timed(spark, [(0, "x", 2**31 - 1), (1, "x", 2**31 - 1)]).withColumn("n", F.col("n").cast("int"))
    assert windows.tumbling(df, "ts", "5 seconds", {"s": ("sum", "n")}).first()["s"] == 2**32 - 2


def test_panes_give_the_same_sliding_windows(spark):
    df = timed(spark, [(i * 700, "ab"[i % 2], i) for i in range(60)])
    measures = {"c": ("count", "1"), "s": ("sum", "n"), "hi": ("max", "n"), "lo": ("min", "n")}
    args = (df, "ts", "10 seconds", "1 second", measures, ["key"])
    direct = windows.sliding(*args, panes_from=1000)
    panes = windows.sliding(*args)
    assert sorted(map(str, panes.collect())) == sorted(map(str, direct.collect()))
    uneven = windows.sliding(df, "ts", "10 seconds", "3 seconds", measures, ["key"], panes_from=2)
    assert uneven.count() > 0


def test_sessions_one_gap_apart_merge(spark):
    df = timed(spark, [(0, "x", 1), (10_000, "x", 2), (20_001, "x", 4)])
    got = bounds(windows.sessions(df, "ts", "10 seconds", {"s": ("sum", "n")}, ["key"]))
    assert sorted((r.window_start, r.window_end, r.s) for r in got.collect()) == [(0, 20_000, 3), (20_001, 30_001, 4)]


def test_all_reduce_takes_the_first_word(spark):
    df = timed(spark, [(5, "b", 2), (1, "a", 3), (2, "b", 1), (3000, "c", 1)])
    got = windows.tumbling_all_reduce(df.withColumnsRenamed({"key": "word", "n": "cnt"}), "ts", "3 seconds", "ms")
    assert sorted((r.word, r.cnt) for r in got.collect()) == [("a", 6), ("c", 1)]


def test_global_window_of_milliseconds(spark):
    df = spark.createDataFrame([(0, "a b"), (9, "c"), (10, "d ")], "ms bigint, value string")
    got = jobs.window_all_count(df.withColumn("arrival_ts", F.timestamp_millis("ms"))).collect()
    assert sorted(r.cnt for r in got) == [1, 3]


def test_json_window_count(spark):
    df = spark.createDataFrame([(0, "com", 2), (9999, "com", 3), (10_000, "com", 1)], "ms bigint, name string, age int")
    got = jobs.json_window_count(df.withColumn("arrival_ts", F.timestamp_millis("ms"))).collect()
    assert sorted((r.name, r.cnt) for r in got) == [("com", 1), ("com", 2)]


def test_word_top_n_over_a_long_bucket_keeps_words_apart(spark):
    df = spark.createDataFrame([(1000, "a,b,a"), (6000, "a")], "ms bigint, value string")
    got = jobs.word_top_n(df.withColumn("arrival_ts", F.timestamp_millis("ms")), bucket="60 seconds").orderBy("rank")
    # Windows ending at 5, 10 and 15 s: a=2 b=1, a=3 b=1, a=1.
    assert [(r.word, r.cnt) for r in got.collect()] == [("a", 3), ("a", 2), ("a", 1), ("b", 1), ("b", 1)]
