"""Ordered per-key computation, above all that splitting hot keys changes nothing."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from rillrank.operators import ordered
from rillrank.operators.alerts import threshold_alerts
from rillrank.operators.ordered import Skew
from rillrank.operators.windows import count_window_all, count_window_slide, sessions

PLAIN = Skew()
SKEWS = {
    "hot keys broadcast": Skew(chunk_rows=40),
    "many pieces": Skew(chunk_rows=2),
    "too many hot keys to list": Skew(chunk_rows=20, max_hot_keys=0),
    "few rows at once": Skew(chunk_rows=10),
}


def rows_of(df):
    return sorted(tuple(map(str, r)) for r in df.select(*sorted(df.columns)).collect())


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of all rows on one key, a NULL key, uneven gaps and a far outlier in the order."""
    rnd = random.Random(7)
    seq, rows = -10**12, []
    for i in range(900):
        key = "hot" if i % 3 == 0 else (None if i % 50 == 1 else f"k{rnd.randrange(60)}")
        value = None if rnd.random() < 0.05 else rnd.randrange(-50, 300)
        rows.append((seq, key, value))
        seq = 0 if i == 0 else seq + rnd.choice([1, 1, 2, 3, 40, 5000])
    rnd.shuffle(rows)
    return spark.createDataFrame(rows, "seq bigint, key string, value bigint").repartition(5)


def by_hand(df):
    totals, largest, count, out = {}, {}, {}, []
    for r in sorted(df.collect(), key=lambda r: r.seq):
        count[r.key] = count.get(r.key, 0) + 1
        if r.value is not None:
            totals[r.key] = totals.get(r.key, 0) + r.value
            largest[r.key] = max(largest.get(r.key, r.value), r.value)
        out.append((r.key, count[r.key], largest.get(r.key), r.seq, totals.get(r.key)))
    return sorted(tuple(map(str, r)) for r in out)


@pytest.mark.parametrize("skew", [PLAIN, *SKEWS.values()], ids=["plain", *SKEWS])
def test_running_aggregates(skewed, skew):
    got = ordered.running(skewed, ["key"], "seq", {
        "total": (ordered.SUM, F.col("value")),
        "largest": (ordered.MAX, F.col("value")),
        "n": (ordered.COUNT, F.lit(1)),
    }, skew)
    got = got.select("key", F.col("n").alias("l0"), F.col("largest").alias("l1"), "seq", F.col("total").alias("z"))
    assert sorted(tuple(map(str, r)) for r in got.collect()) == by_hand(skewed)


@pytest.mark.parametrize("skew", SKEWS.values(), ids=SKEWS)
def test_global_numbering(skewed, skew):
    got = ordered.number_rows(skewed, [], "seq", "no", skew).orderBy("seq").select("no").collect()
    assert [r.no for r in got] == list(range(1, 901))


def operators(skewed):
    keyed = skewed.filter("key is not null")
    timed = keyed.filter("seq >= 0").withColumn("ts", F.timestamp_seconds("seq"))
    measures = {"n": ("count", "1"), "total": ("sum", "value"), "low": ("min", "value")}
    return [
        lambda s: threshold_alerts(keyed, skew=s),
        lambda s: count_window_all(skewed, "seq", 5, "value", s),
        lambda s: count_window_slide(keyed, ["key"], "seq", 5, 2, "value", s),
        lambda s: count_window_slide(keyed, ["key"], "seq", 2, 5, "value", s),
        lambda s: sessions(timed, "ts", "3 seconds", measures, ["key"], s),
        lambda s: sessions(timed, "ts", "100 seconds", measures, ["key"], s),
    ]


@pytest.fixture(scope="module")
def plain(skewed):
    return [rows_of(op(PLAIN)) for op in operators(skewed)]


@pytest.mark.parametrize("skew", SKEWS.values(), ids=SKEWS)
def test_split_equals_plain(skewed, plain, skew):
    for op, want in zip(operators(skewed), plain):
        assert rows_of(op(skew)) == want


def test_one_order_value_for_all_rows(spark):
    df = spark.range(50).select(F.lit("k").alias("key"), F.lit(7).cast("bigint").alias("seq"), F.lit(1).alias("v"))
    chunked = ordered.chunk_hot_keys(df, ["key"], "seq", Skew(chunk_rows=10))
    assert chunked.split and chunked.rows.select(ordered.CHUNK).distinct().count() == 1


def test_hot_key_is_spread(spark):
    df = spark.range(100_000).select((F.col("id") % 3 == 0).cast("string").alias("key"), F.col("id").alias("seq"))
    chunked = ordered.chunk_hot_keys(df, ["key"], "seq", Skew(chunk_rows=200))
    largest = chunked.rows.groupBy("key", ordered.CHUNK).count().agg(F.max("count")).first()[0]
    assert largest <= 1000


def test_cold_keys_need_no_join(skewed):
    chunked = ordered.chunk_hot_keys(skewed, ["key"], "seq")
    assert not chunked.split


@pytest.mark.parametrize("seed", range(3))
def test_alert_count_is_breaches_over_times(spark, seed):
    rnd = random.Random(seed)
    data = [(i, rnd.choice("abc"), rnd.randrange(200)) for i in range(200)]
    df = spark.createDataFrame(data, "seq bigint, key string, value bigint")
    n = rnd.randrange(1, 6)
    got = {r["key"]: r["count"] for r in threshold_alerts(df, times=n).groupBy("key").count().collect()}
    for key in "abc":
        assert got.get(key, 0) == sum(k == key and v >= 100 for _, k, v in data) // n


def test_double_totals_are_the_same_when_split(spark):
    rnd = random.Random(5)
    rows = spark.createDataFrame([(i, "hot", rnd.random() * 10 ** rnd.randrange(-3, 6)) for i in range(500)],
                                 "seq bigint, key string, value double")
    plain = ordered.running_sum(rows, ["key"], "seq", "value")
    assert dict(plain.dtypes)["total"] == "double"
    for skew in SKEWS.values():
        assert rows_of(ordered.running_sum(rows, ["key"], "seq", "value", skew=skew)) == rows_of(plain)


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz"])
@pytest.mark.parametrize("gap", ["1 hour 30 minutes", "20 minutes"])
def test_sessions_with_null_times_and_a_clock_change(spark, kind, gap):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        rnd = random.Random(9)
        rows = [("hot", None if i % 10 == 0 else f"2024-11-03 0{rnd.randrange(6)}:{rnd.randrange(60):02}:{i % 60:02}")
                for i in range(80)]
        rows = spark.createDataFrame(rows, "key string, at string").withColumn("ts", F.col("at").cast(kind))
        measures = {"n": ("count", "1")}
        plain = sessions(rows, "ts", gap, measures, ["key"])
        split = sessions(rows, "ts", gap, measures, ["key"], Skew(chunk_rows=7))
        assert rows_of(split) == rows_of(plain)
        assert sum(r.n for r in plain.collect()) == 72
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
