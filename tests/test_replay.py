"""Replays of stored tables in steps: their cuts, their files, and streams that run over them."""

from __future__ import annotations

import datetime

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import __spark_entry__ as entry
from rillrank.plans import inputs, jobs as batch_jobs
from rillrank.sources import replay
from rillrank.streaming import jobs, sinks


def ranges(*pairs):
    return [replay.FileRange(f"f{i}", a, b) for i, (a, b) in enumerate(pairs)]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 40), st.integers(0, 5)), max_size=20), st.integers(1, 6))
def test_no_later_file_begins_before_an_earlier_one_ends(pairs, wanted):
    files = ranges(*[(a, a + n) for a, n in pairs])
    steps = replay.plan_steps(files, wanted)
    assert len(steps) <= wanted and sorted(r.path for s in steps for r in s) == sorted(r.path for r in files)
    for i in range(1, len(steps)):
        assert max(r.last for s in steps[:i] for r in s) < min(r.first for r in steps[i])


def test_steps_are_even_and_files_without_values_come_first():
    files = ranges(*[(i, i) for i in range(8)]) + [replay.FileRange("none", None, None)]
    assert [len(s) for s in replay.plan_steps(files, 4)] == [3, 2, 2, 2]
    assert replay.plan_steps(files, 4)[0][0].path == "none"
    assert replay.plan_steps([], 3) == []


@pytest.fixture
def events(spark, tmp_path, sf_dir):
    """The events in twelve files by time, in names that say nothing of it."""
    rows = spark.read.parquet(f"{sf_dir}/events.parquet")
    n = rows.count()
    folder = tmp_path / "events.parquet"
    folder.mkdir()
    for i in range(12):
        part = tmp_path / f"part{i}"
        rows.where(F.floor(F.col("event_id") * 12 / n) == i).coalesce(1).write.parquet(str(part))
        for file in part.glob("*.parquet"):
            file.rename(folder / f"{(i * 5) % 12:02} x+%20.parquet")
    return rows, str(folder)


def closed(rows):
    """Ranks of the windows that the watermark has passed at the end."""
    traffic = inputs.as_traffic(rows)
    last = rows.agg(F.max("ts")).first()[0] - datetime.timedelta(seconds=5)
    ranked = batch_jobs.top_hosts(traffic, "session_num", size="1 hour")
    return {tuple(r) for r in ranked.collect() if datetime.datetime(1970, 1, 1) + datetime.timedelta(milliseconds=r.window_end_ms) <= last}


def timed(events):
    return inputs.as_traffic(events.withColumn("ts", F.col("ts").cast("timestamp")))


def test_a_stream_over_the_tables_own_files(spark, events, tmp_path):
    rows, path = events
    plan = replay.replay_of(spark, path, "ts", 4)
    assert len(plan.steps) == 4 and all(s.folder == path for s in plan.steps), "ordered files need no copy"

    def start(step):
        return jobs.stream_top_hosts(timed(step), f"{tmp_path}/out", f"{tmp_path}/ck", size="1 hour", every=None)

    reports = replay.run(plan, spark, start)
    flat = [p for step in reports for p in step]
    assert sum(p["numInputRows"] > 0 for p in flat) >= 4
    assert sum(p["stateOperators"][0]["numRowsRemoved"] for p in flat[:-1] if p["stateOperators"]) > 0, "state is evicted on the way"
    assert sum(p["stateOperators"][0]["numRowsDroppedByWatermark"] for p in flat if p["stateOperators"]) == 0
    got = {tuple(r) for r in sinks.read_batches(spark, f"{tmp_path}/out").drop(sinks.BATCH).collect()}
    assert got == closed(rows)
    # All steps again change nothing: the checkpoint knows their files.
    assert sum(p["numInputRows"] for step in replay.run(plan, spark, start) for p in step) == 0
    assert {tuple(r) for r in sinks.read_batches(spark, f"{tmp_path}/out").drop(sinks.BATCH).collect()} == got


def test_a_replay_goes_on_where_it_stopped(spark, events, tmp_path):
    rows, path = events
    made = []

    def make():
        made.append(1)
        return replay.ordered_copy(spark, path, "ts", 3)

    def start(step):
        return jobs.stream_top_hosts(timed(step), f"{tmp_path}/out", f"{tmp_path}/ck", size="1 hour", every=None)

    plan = replay.remembered(spark, f"{tmp_path}/steps", make)
    replay.run(replay.Replay(plan.schema, plan.steps[:2]), spark, start)
    again = replay.remembered(spark, f"{tmp_path}/steps", make)
    assert again == plan and made == [1]
    reports = replay.run(again, spark, start)
    assert [sum(p["numInputRows"] for p in step) > 0 for step in reports] == [False, False, True]
    assert {tuple(r) for r in sinks.read_batches(spark, f"{tmp_path}/out").drop(sinks.BATCH).collect()} == closed(rows)


def test_overlapping_files_are_cut_by_time(spark, events, tmp_path):
    rows, path = events
    mixed = f"{tmp_path}/mixed.parquet"
    rows.repartition(5, "user_id").write.parquet(mixed)
    plan = replay.replay_of(spark, mixed, "ts", 4)
    parts = [spark.read.schema(plan.schema).parquet(s.folder).agg(F.min("ts"), F.max("ts"), F.count("*")).first() for s in plan.steps]
    assert len(parts) == 4 and sum(p[2] for p in parts) == rows.count()
    assert all(a[1] < b[0] for a, b in zip(parts, parts[1:]))


def test_names_that_are_patterns_lead_to_a_copy(spark, events, tmp_path):
    rows, _ = events
    folder = tmp_path / "odd.parquet"
    rows.where("event_id < 10").coalesce(1).write.parquet(str(tmp_path / "one"))
    folder.mkdir()
    next((tmp_path / "one").glob("*.parquet")).rename(folder / "a{x},[y].parquet")
    plan = replay.replay_of(spark, str(folder), "event_id", 1)
    assert [spark.read.parquet(s.folder).count() for s in plan.steps] == [10]


def test_tables_of_one_file_one_value_or_no_rows(spark, tmp_path, events):
    rows, _ = events
    rows.limit(0).write.parquet(f"{tmp_path}/empty.parquet")
    rows.withColumn("event_id", F.lit(5).cast("bigint")).coalesce(1).write.parquet(f"{tmp_path}/same.parquet")
    for name, n in (("empty", 0), ("same", rows.count())):
        plan = replay.replay_of(spark, f"{tmp_path}/{name}.parquet", "event_id", 3)
        reports = replay.run(plan, spark, lambda step: sinks.start(
            step, sinks.to_files(f"{tmp_path}/{name}-out"), f"{tmp_path}/{name}-ck", every=None))
        assert sum(p["numInputRows"] for step in reports for p in step) == n


def test_late_rows_are_in_no_total(spark, sf_dir):
    """The checked query with late rows does leave some out."""
    late = entry.queries()["stream_top_hosts_late"](spark, sf_dir)
    whole = entry.queries()["stream_top_hosts"](spark, sf_dir)
    a, b = (df.agg(F.sum("session_num")).first()[0] for df in (late, whole))
    assert 0 < a < b
