"""Whole jobs from lines to written results, started as a user starts them."""

from __future__ import annotations

import json

import pytest

from rillrank import __main__ as command
from rillrank.streaming import sinks


@pytest.fixture
def start(spark, tmp_path):
    (tmp_path / "in").mkdir()

    def run(job, files, *options):
        for i, lines in enumerate(files):
            (tmp_path / "in" / f"{i}.txt").write_text("".join(line + "\n" for line in lines))
        args = command.parse([job, "--source", "files", "--path", str(tmp_path / "in"), "--once",
                              "--out", str(tmp_path / "out"), "--checkpoint", str(tmp_path / "ck"), *options])
        for query in command.run(spark, args):
            query.awaitTermination()
        return sinks.read_batches(spark, str(tmp_path / "out"))
    return run


def hit(ms, host, **more):
    return json.dumps({"client_ip": host, "recv_time": ms, **more})


def test_top_hosts_from_json_lines(spark, start, tmp_path):
    lines = [hit(1000, "a", c2s_byte_num=1), hit(1500, "b", s2c_byte_num=70), hit(2000, "a"), "bad",
             hit(None, "no time"), json.dumps({"recv_time": 1700}), hit(30_000, "end")]
    got = start("top-hosts", [lines], "--order-by", "bytes", "--n", "2", "--rejects", str(tmp_path / "bad"))
    assert [(r.window_end_ms, r.rank, r.client_ip, r.session_num) for r in got.orderBy("rank").collect()] == [
        (5000, 1, "b", 1), (5000, 2, "a", 2)]
    assert [r.value for r in sinks.read_batches(spark, str(tmp_path / "bad")).collect()] == ["bad"]


def test_report_from_json_lines(start):
    got = start("top-hosts", [[hit(1000, "a"), hit(30_000, "end")]], "--report").collect()
    assert len(got) == 1 and "客户端IP=a \t会话次数=1" in got[0].report


def test_running_word_count(start):
    got = start("running-word-count", [["a,b,a", "", "b"]]).collect()
    assert [(r.word, r.total) for r in got] == [("a", 2)]


def test_running_max(start):
    assert sorted((r.word, r.largest) for r in start("running-max", [["a,1", "a,4", "b,2"]], "--failfast").collect()) \
        == [("a", 4), ("b", 2)]


@pytest.mark.parametrize("job", ["word-top-n", "json-window-count", "window-all-count", "word-sessions"])
def test_arrival_time_windows_start(start, job):
    # All lines arrive at once, so no window is closed yet; the job must run and write nothing.
    assert start(job, [['{"name":"com","age":2}', "hello,stream"]]).count() == 0


@pytest.mark.parametrize("job, rows", [("threshold-alerts", 3), ("breach-flags", 8)])
def test_threshold_jobs(spark, tmp_path, pairs, job, rows):
    pairs.coalesce(1).write.parquet(str(tmp_path / "pairs"))
    args = command.parse([job, "--path", str(tmp_path / "pairs"), "--once",
                          "--out", str(tmp_path / "out"), "--checkpoint", str(tmp_path / "ck")])
    for query in command.run(spark, args):
        query.awaitTermination()
    assert sinks.read_batches(spark, str(tmp_path / "out")).count() == rows


@pytest.mark.parametrize("job, options, columns, expected", [
    ("record-sums", [], ("key", "total"), [("a", 50), ("a", 130), ("a", 530), ("b", 100), ("b", 300)]),
    ("record-maxima", [], ("key", "largest"), [("a", 50), ("a", 80), ("a", 400), ("b", 100), ("b", 200)]),
    ("carried-alerts", ["--times", "2", "--threshold", "80"], ("key", "last_seq"), [("a", 3), ("b", 5)]),
    ("count-window-all", ["--size", "2"], ("last_seq", "total"), [(2, 130), (4, 500)]),
    ("count-window-slide", ["--size", "2", "--slide", "2"], ("key", "last_seq", "total"), [("a", 2, 130), ("b", 5, 300)]),
])
def test_jobs_with_carried_rows(spark, tmp_path, job, options, columns, expected):
    rows = [(1, "a", 50), (2, "a", 80), (3, "a", 400), (4, "b", 100), (5, "b", 200)]
    for part in (rows[:3], rows[3:]):
        spark.createDataFrame(part, "seq bigint, key string, value bigint").coalesce(1).write.mode("append").parquet(
            str(tmp_path / "pairs"))
    args = command.parse([job, "--path", str(tmp_path / "pairs"), "--once", "--files-per-trigger", "1",
                          "--out", str(tmp_path / "out"), "--checkpoint", str(tmp_path / "ck"), *options])
    for query in command.run(spark, args):
        query.awaitTermination()
    written = sinks.read_batches(spark, str(tmp_path / "out"))
    assert sorted(tuple(r[c] for c in columns) for r in written.collect()) == expected


def test_unknown_job():
    with pytest.raises(SystemExit):
        command.parse(["other", "--out", "o", "--checkpoint", "c"])


def test_counts_per_record_from_text_files(spark, start, tmp_path):
    """Two starts over the same folder: counts go on, and a word that a line repeats follows itself."""
    start("line-counts", [["a,b,a", "", "a", "b,b,a"], ["x,a", "a"]])
    first = sinks.read_batches(spark, str(tmp_path / "out")).collect()
    assert sorted(r.total for r in first) == [1, 2, 3, 4, 5, 6] and [r.seq for r in sorted(first, key=lambda r: r.total)] == [*range(1, 7)]
    got = start("line-counts", [["a,b,a", "", "a", "b,b,a"], ["x,a", "a"], ["a,a", "c"]]).collect()
    assert sorted(r.total for r in got) == [*range(1, 9)] and {r.word for r in got} == {"a"}


def test_maxima_per_record_from_text_files(spark, start, tmp_path):
    got = start("line-maxima", [["a,3", "a,1", "b,5", "a,7", "b,2"]]).orderBy("seq").collect()
    assert [(r.word, r["count"], r.largest) for r in got] == [("a", 3, 3), ("a", 1, 3), ("b", 5, 5), ("a", 7, 7), ("b", 2, 5)]


def test_results_are_printed_too(start, monkeypatch):
    """Rows are printed by the executors; here the sink says what it was given."""
    shown = []
    monkeypatch.setattr(sinks, "to_console", lambda: lambda batch, batch_id: shown.extend(batch.collect()))
    got = start("top-hosts", [[hit(1000, "a"), hit(30_000, "end")]], "--print", "--delay", "2 seconds").collect()
    assert [r.client_ip for r in got] == [r.client_ip for r in shown] == ["a"]
