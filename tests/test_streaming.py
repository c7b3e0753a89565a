"""Streams fed file by file, compared with the batch form."""

from __future__ import annotations

import datetime
import random

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from rillrank.operators import alerts, ordered, windows
from rillrank.operators.ordered import Skew
from rillrank.plans import jobs as batch_jobs
from rillrank.sources.lines import read_table
from rillrank.streaming import carry, jobs, processors, sinks


class Feed:
    """A folder of files taken in one per micro-batch, in the order they were added."""

    def __init__(self, spark, root, schema):
        self.spark, self.root, self.schema = spark, root, schema
        self.path, self.out, self.carry, self.checkpoint = (str(root / n) for n in ("in", "out", "carry", "ck"))
        self.files = 0

    def add(self, *rows):
        staged = self.root / f"stage{self.files}"
        df = self.spark.createDataFrame(list(rows), self.schema).coalesce(1)
        df.write.parquet(str(staged))
        (self.root / "in").mkdir(exist_ok=True)
        for part in staged.glob("*.parquet"):
            part.rename(self.root / "in" / f"{self.files:04}.parquet")
        self.files += 1

    def stream(self):
        schema = self.spark.createDataFrame([], self.schema).schema
        return read_table(self.spark, self.path, schema, max_files_per_trigger=1)

    def all(self):
        return self.spark.read.parquet(self.path)

    def written(self):
        return sinks.read_batches(self.spark, self.out)


@pytest.fixture
def feed(spark, tmp_path):
    return lambda schema: Feed(spark, tmp_path, schema)


def finish(query):
    query.awaitTermination()
    return query


TRAFFIC = ("recv_time bigint, client_ip string, c2s_pkt_num int, s2c_pkt_num int,"
           " c2s_byte_num int, s2c_byte_num int")
PAIRS = "seq bigint, key string, value bigint"


def hit(ms, host):
    return ms, host, 1, 2, 3, 4


def traffic_stream(f):
    return f.stream().withColumn("event_time", F.timestamp_millis("recv_time"))


def test_top_hosts_and_late_rows(feed):
    f = feed(TRAFFIC)
    f.add(hit(1000, "a"), hit(2000, "a"), hit(2500, "b"), hit(11_000, "c"))  # watermark 6 s
    f.add(hit(3000, "late"), hit(7000, "d"))  # window 0-5 s is closed, 5-10 s is open
    f.add(hit(30_000, "end"))
    f.add(hit(60_000, "end"))
    finish(jobs.stream_top_hosts(traffic_stream(f), f.out, f.checkpoint, every=None))
    got = f.written().orderBy("window_end_ms", "rank").collect()
    assert [(r.window_end_ms, r.rank, r.client_ip, r.session_num) for r in got] == [
        (5000, 1, "a", 2), (5000, 2, "b", 1), (10_000, 1, "d", 1), (15_000, 1, "c", 1), (35_000, 1, "end", 1)]


def test_top_hosts_by_timer_equals_plain(feed):
    f = feed(TRAFFIC)
    rnd = random.Random(3)
    for i in range(3):
        f.add(*[hit(i * 5000 + rnd.randrange(5000), f"h{rnd.randrange(12)}") for _ in range(80)])
    f.add(hit(60_000, "end"))
    f.add(hit(90_000, "end"))
    finish(jobs.stream_top_hosts_by_timer(traffic_stream(f), f.out, f.checkpoint, "bytes", every=None))
    want = batch_jobs.top_hosts(f.all().withColumn("event_time", F.timestamp_millis("recv_time")), "bytes")
    got = f.written().drop("batch_id")
    assert sorted(got.collect()) == sorted(want.filter("window_end_ms <= 65000").collect())


def test_word_top_n_in_short_and_long_buckets(feed):
    f = feed("ms bigint, value string")
    f.add((1000, "a,B,b"), (6000, "c,a,a"))
    f.add((40_000, "x"))
    f.add((80_000, "x"))
    lines = f.stream().withColumn("arrival_ts", F.timestamp_millis("ms"))
    finish(jobs.stream_word_top_n(lines, f.out, f.checkpoint, bucket="60 seconds", n=3, every=None))
    got = jobs.bucket_top_n(f.written(), 3)
    want = batch_jobs.word_top_n(
        f.all().withColumn("arrival_ts", F.timestamp_millis("ms")).filter("ms < 80000"), bucket="60 seconds", n=3)
    assert sorted(map(str, got.collect())) == sorted(map(str, want.select(got.columns).collect()))


def test_updates_per_batch(feed):
    f = feed("seq bigint, value string")
    f.add((0, "a,b,a"), (1, "b"))
    f.add((2, "a,,"))
    finish(jobs.stream_word_count(f.stream(), f.out, f.checkpoint, every=None))
    rows = f.written().orderBy("batch_id").collect()
    assert [(r.word, r.total) for r in rows] == [("a", 2), ("a", 3)]
    assert [tuple(r) for r in sinks.latest_updates(f.written(), ["word"]).collect()] == [("a", 3)]


def test_running_max_updates(feed):
    f = feed("seq bigint, value string")
    f.add((0, "a,5"), (1, "b,1"))
    f.add((2, "a,3"), (3, "b,9"))
    finish(jobs.stream_running_max(f.stream(), f.out, f.checkpoint, every=None))
    latest = sinks.latest_updates(f.written(), ["word"]).collect()
    assert sorted(tuple(r) for r in latest) == [("a", 5), ("b", 9)]


def random_pairs(f, files=4, rows=60):
    rnd = random.Random(11)
    seq = 0
    for _ in range(files):
        batch = []
        for _ in range(rows):
            batch.append((seq, "hot" if seq % 3 == 0 else f"k{rnd.randrange(5)}", rnd.randrange(200)))
            seq += rnd.choice([1, 2, 10])
        rnd.shuffle(batch)  # arrival order inside a file is by seq, not by place
        f.add(*batch)


def as_set(df, *columns):
    return sorted(tuple(map(str, r)) for r in df.select(*columns).collect())


SKEWS = [Skew(), Skew(chunk_rows=8)]
ALERT = ("key", "last_seq", "message", "abnormal_values")


def test_threshold_alerts_with_state(feed):
    f = feed(PAIRS)
    random_pairs(f)
    found = processors.threshold_alerts(f.stream())
    finish(sinks.start(found, sinks.to_alert_files(f.out), f.checkpoint, every=None))
    assert as_set(f.written(), *ALERT) == as_set(alerts.threshold_alerts(f.all()), *ALERT)


def test_restart_in_the_middle_of_an_alert(feed):
    f = feed(PAIRS)
    def run():
        finish(sinks.start(processors.threshold_alerts(f.stream()), sinks.to_alert_files(f.out), f.checkpoint, every=None))
    f.add((0, "a", 400), (1, "a", 100), (2, "b", 100))
    run()
    assert f.written().count() == 0
    f.add((3, "a", 50), (4, "a", 200), (5, "b", 100))
    run()
    assert [(r.key, r.abnormal_values) for r in f.written().collect()] == [("a", [400, 100, 200])]


def test_sliding_count_with_state(feed):
    f = feed(PAIRS)
    random_pairs(f)
    sums = processors.count_window_slide(f.stream(), "key", "seq", 5, 2, "value")
    finish(sinks.start(sums, sinks.to_files(f.out), f.checkpoint, every=None))
    columns = ("key", "fired_at", "last_seq", "total")
    assert as_set(f.written(), *columns) == as_set(
        windows.count_window_slide(f.all(), ["key"], "seq", 5, 2, "value"), *columns)


@pytest.mark.parametrize("skew", SKEWS, ids=["plain", "split"])
@pytest.mark.parametrize("name", ["alerts", "all", "slide", "jump", "sum", "max"])
def test_carried_steps(feed, name, skew):
    f = feed(PAIRS)
    random_pairs(f, files=3, rows=40)
    whole = Skew()
    step, want, columns = {
        "alerts": lambda: (carry.threshold_alerts(skew=skew), alerts.threshold_alerts(f.all()), ALERT),
        "all": lambda: (carry.count_window_all("seq", 7, "value", skew),
                        windows.count_window_all(f.all(), "seq", 7, "value"), ("last_seq", "total")),
        "slide": lambda: (carry.count_window_slide(["key"], "seq", 5, 2, "value", skew),
                          windows.count_window_slide(f.all(), ["key"], "seq", 5, 2, "value"),
                          ("key", "last_seq", "total")),
        "jump": lambda: (carry.count_window_slide(["key"], "seq", 2, 3, "value", skew),
                         windows.count_window_slide(f.all(), ["key"], "seq", 2, 3, "value"),
                         ("key", "last_seq", "total")),
        "sum": lambda: (carry.running_sum(["key"], "seq", "value", skew=skew),
                        ordered.running_sum(f.all(), ["key"], "seq", "value", skew=whole),
                        ("seq", "key", "value", "total")),
        "max": lambda: (carry.running_max(["key"], "seq", "value", skew=skew),
                        ordered.running_max(f.all(), ["key"], "seq", "value", skew=whole),
                        ("seq", "key", "value", "largest")),
    }[name]()
    finish(carry.start(f.stream(), step, "seq", f.out, f.carry, f.checkpoint, every=None))
    assert as_set(f.written(), *columns) == as_set(want, *columns)


def test_a_carried_batch_that_failed_before_its_commit_is_run_again(feed):
    f = feed(PAIRS)
    random_pairs(f, files=3, rows=30)
    def run():
        finish(carry.start(f.stream(), carry.threshold_alerts(skew=Skew(chunk_rows=5)), "seq",
                           f.out, f.carry, f.checkpoint, every=None))
    run()
    first = as_set(f.written(), "batch_id", *ALERT)
    commits = f.root / "ck" / "commits"
    for name in ("2", ".2.crc"):
        (commits / name).unlink()
    f.add((10**6, "hot", 500))
    run()
    again = as_set(f.written().filter("batch_id <= 2"), "batch_id", *ALERT)
    assert again == first
    assert as_set(f.written(), *ALERT) == as_set(alerts.threshold_alerts(f.all()), *ALERT)


def test_a_batch_run_twice_changes_nothing(feed, spark):
    f = feed(PAIRS)
    write = sinks.to_files(f.out)
    df = spark.createDataFrame([(1, "a", 2)], PAIRS)
    write(df, 0)
    write(df, 0)
    assert f.written().count() == 1


def test_console_prints_every_row(spark, capsys, monkeypatch):
    # Tasks print to their own output; here the rows of all partitions are printed by the test itself.
    frame = type(spark.range(1))
    monkeypatch.setattr(frame, "foreachPartition", lambda self, f: f(self.toLocalIterator()))
    sinks.to_console()(spark.range(25), 7)
    out = capsys.readouterr().out
    assert all(f"Row(id={i}, batch_id=7)" in out for i in range(25))


def test_single_operator_setting_is_put_back(spark):
    name = "spark.sql.streaming.statefulOperator.allowMultiple"
    before = spark.conf.get(name, None)
    with sinks.single_operator(spark):
        assert spark.conf.get(name) == "false"
    assert spark.conf.get(name, None) == before


def test_alert_times_must_be_positive(pairs):
    with pytest.raises(ValueError):
        alerts.threshold_alerts(pairs, times=0)
    with pytest.raises(ValueError):
        processors.threshold_alerts(pairs, times=0)


@pytest.mark.parametrize("make", [
    processors.threshold_alerts, lambda df: processors.count_window_slide(df, "key", "seq", 5, 2, "value")],
    ids=["alerts", "sliding count"])
def test_a_row_that_goes_back_stops_the_query(feed, make):
    f = feed(PAIRS)
    f.add((5, "a", 400), (6, "a", 300))
    f.add((4, "a", 200))
    query = sinks.start(make(f.stream()), sinks.to_files(f.out), f.checkpoint, every=None)
    with pytest.raises(StreamingQueryException):
        query.awaitTermination()


def test_streamed_sliding_count_with_nulls_equals_batch(feed):
    f = feed("seq bigint, key string, value int")
    big = 2_000_000_000
    f.add(*[(i, "a", None if i == 3 else big) for i in range(6)], (6, "b", None), (7, "b", None))
    f.add(*[(i, "a", big) for i in range(8, 14)])
    sums = processors.count_window_slide(f.stream(), "key", "seq", 3, 2, "value")
    finish(sinks.start(sums, sinks.to_files(f.out), f.checkpoint, every=None))
    columns = ("key", "fired_at", "last_seq", "total")
    assert as_set(f.written(), *columns) == as_set(
        windows.count_window_slide(f.all(), ["key"], "seq", 3, 2, "value"), *columns)


def test_carried_total_of_an_int_column_passes_its_range(feed):
    f = feed("seq bigint, key string, value int")
    for i in range(3):
        f.add((i, "a", 2_000_000_000))
    finish(carry.start(f.stream(), carry.running_sum(["key"], "seq", "value"), "seq", f.out, f.carry, f.checkpoint, every=None))
    got = f.written().orderBy("seq")
    assert dict(got.dtypes)["value"] == "int"
    assert [r.total for r in got.collect()] == [2_000_000_000, 4_000_000_000, 6_000_000_000]


def test_streamed_panes_equal_plain_windows(feed):
    """Three-second panes under 30-second windows, over several triggers; no copies are made before the first sum."""
    f = feed("ts timestamp, k string, v bigint")
    rnd = random.Random(11)
    at = 0
    for _ in range(5):
        rows = []
        for _ in range(40):
            at += rnd.choice([0, 1, 1, 2, 7])
            rows.append((datetime.datetime(2024, 1, 1) + datetime.timedelta(seconds=at), rnd.choice("ab"), rnd.randrange(9)))
        f.add(*rows)
    measures = {"n": ("count", "1"), "total": ("sum", "v"), "most": ("max", "v")}
    query = finish(jobs.stream_sliding(f.stream(), f.out, f.checkpoint, "30 seconds", "3 seconds", measures, ["k"], ts="ts", every=None))
    batch = windows.sliding(f.all(), "ts", "30 seconds", "3 seconds", measures, ["k"], panes_from=99)
    last = datetime.datetime(2024, 1, 1) + datetime.timedelta(seconds=at - 5)
    want = {tuple(r) for r in batch.collect() if r.window_end <= last}
    assert {tuple(r) for r in f.written().drop(sinks.BATCH).collect()} == want
    assert sum(p["numInputRows"] > 0 for p in query.recentProgress) >= 5
    plan = windows.sliding(f.stream().withWatermark("ts", "5 seconds"), "ts", "30 seconds", "3 seconds", measures, ["k"])
    logical = plan._jdf.queryExecution().analyzed().toString()
    assert logical.index("Aggregate") < logical.index("Expand") < logical.rindex("Aggregate")
