from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from rillrank.operators import ranking
from rillrank.plans import jobs


def traffic(spark, rows):
    """rows: (ms, client_ip, c2s_pkt, s2c_pkt, c2s_byte, s2c_byte)"""
    schema = ("recv_time bigint, client_ip string, c2s_pkt_num int, s2c_pkt_num int,"
              " c2s_byte_num int, s2c_byte_num int")
    return spark.createDataFrame(rows, schema).withColumn("event_time", F.timestamp_millis("recv_time"))


def names(df):
    return [r.client_ip for r in df.orderBy("window_end_ms", "rank").collect()]


ROWS = [
    (0, "a", 1, 1, 100, 1), (1, "a", 1, 1, 100, 1), (2, "b", 50, 1, 1, 1), (3, "b", 1, 1, 1, 1),
    (4, "c", 1, 9, 5, 900), (4999, "d", 1, 1, 1, 1), (5000, "e", 1, 1, 1, 1),
]


def test_orders(spark):
    df = traffic(spark, ROWS)
    assert names(jobs.top_hosts(df)) == ["a", "b", "c", "d", "e"]
    assert names(jobs.top_hosts(df, "bytes")) == ["c", "a", "b", "d", "e"]
    assert names(jobs.top_hosts(df, "packets")) == ["b", "c", "a", "d", "e"]
    assert names(jobs.top_hosts(df, n=1)) == ["a", "e"]


def test_rows_do_not_depend_on_input_order(spark):
    rows = [(i, f"h{i % 9}", i, 1, 1, 1) for i in range(60)]
    first = names(jobs.top_hosts(traffic(spark, rows)))
    random.Random(1).shuffle(rows)
    assert names(jobs.top_hosts(traffic(spark, rows).repartition(4))) == first
    assert len(first) == 5


def test_large_n_is_cut_in_parts(spark):
    df = spark.range(5000).select(
        F.lit(1).alias("g"), F.col("id").cast("string").alias("name"), (F.col("id") % 700).alias("v"))
    got = ranking.top_n(df, ["g"], F.col("v"), "name", 1500).orderBy("rank").collect()
    want = sorted(df.collect(), key=lambda r: (-r.v, r.name))[:1500]
    assert [r.name for r in got] == [r.name for r in want]


def test_rows_are_cut_before_the_shuffle(spark, capsys):
    jobs.top_hosts(traffic(spark, ROWS)).explain()
    plan = capsys.readouterr().out
    assert plan.count("WindowGroupLimit") == 2 and plan.count("Exchange hashpartitioning") == 2


def test_report_text(spark):
    got = jobs.top_hosts_report(traffic(spark, ROWS), "bytes", n=2).orderBy("window_end_ms").collect()
    rule = "=" * 36 + "\n"
    assert got[0].report == (
        rule
        + "No0: \t客户端IP=c \t会话次数=1 \tc2s包数=1 \ts2c包数9 \tc2s字节数=5 \ts2c字节数900"
          " \t时间戳是 :5000 \torerby：bytes\n"
        + "No1: \t客户端IP=a \t会话次数=2 \tc2s包数=2 \ts2c包数2 \tc2s字节数=200 \ts2c字节数2"
          " \t时间戳是 :5000 \torerby：bytes\n"
        + rule + "\n")
    timed = jobs.top_hosts_report(traffic(spark, ROWS), n=1, with_time=True).orderBy("window_end_ms").collect()
    assert timed[0].report.startswith(rule + "时间: 1970-01-01 00:00:05.0\nNo0:")


def test_ten_ranks_stay_in_order(spark):
    rows = [(i, f"h{i % 12:02}", 1, 1, i % 12, 1) for i in range(12)]
    report = jobs.top_hosts_report(traffic(spark, rows), "bytes", n=12).first().report
    assert [line.split(":")[0] for line in report.splitlines()[1:13]] == [f"No{i}" for i in range(12)]


def test_nested_and_flat(spark):
    ranked = jobs.top_hosts(traffic(spark, ROWS))
    nested = ranking.nest_hosts(ranked)
    assert [len(r.hosts) for r in nested.orderBy("window_end_ms").collect()] == [4, 1]
    assert sorted(ranking.flatten_hosts(nested).collect()) == sorted(ranked.collect())
    assert ranking.flatten_hosts(nested).columns == ranking.HOST_COLUMNS


def test_unknown_order(spark):
    with pytest.raises(KeyError):
        jobs.top_hosts(traffic(spark, ROWS), "size")
