"""The parallel prefix scan: its steps batch by batch, and whole scans over many short partitions."""

from __future__ import annotations

import math
import random
from contextlib import contextmanager
from decimal import Decimal
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from rillrank.operators import ordered, scan
from rillrank.operators.ordered import Skew
from rillrank.operators.windows import count_window_slide
from rillrank.streaming.sinks import session_settings

SPLIT = Skew(chunk_rows=10)
VALUES = {
    "bigint": (pa.int64(), lambda rnd: rnd.randrange(-50, 50)),
    "double": (pa.float64(), lambda rnd: rnd.choice([rnd.random() * 10 ** rnd.randrange(-20, 20), 1e300, -1e300, 1e-300, 0.1])),
    "decimal(10,2)": (pa.decimal128(10, 2), lambda rnd: Decimal(rnd.randrange(-999, 999)).scaleb(-2)),
}


@contextmanager
def partitions(spark, n):
    with session_settings(spark, {"spark.sql.shuffle.partitions": str(n), "spark.sql.adaptive.coalescePartitions.enabled": "false"}):
        yield


def exact(values, kind):
    known = [v for v in values if v is not None]
    if not known:
        return None
    if kind != "double":
        return sum(known)
    if not all(map(math.isfinite, known)):
        return sum(known)
    total = sum(map(Fraction, known))
    try:
        return float(total)
    except OverflowError:
        return math.copysign(math.inf, total)


@pytest.mark.parametrize("kind", VALUES)
@pytest.mark.parametrize("seed", range(25))
def test_steps_batch_by_batch(kind, seed):
    rnd = random.Random(f"{kind}{seed}")
    arrow, draw = VALUES[kind]
    n, size = rnd.randrange(1, 60), rnd.randrange(1, 7)
    keys = sorted(rnd.randrange(4) for _ in range(n))
    values = [None if rnd.random() < 0.2 else draw(rnd) for _ in range(n)]
    steps = {"sum": scan._Sum(kind == "double"), "count": scan._Count(), "max": scan._Max(), "slide": scan._Slide(size)}
    got, at = {name: [] for name in steps}, 0
    while at < n:
        end = min(n, at + rnd.randrange(1, 9))
        starts = np.array([i - at for i in range(at, end) if i == 0 or keys[i] != keys[i - 1]], dtype=int)
        for name, step in steps.items():
            got[name] += step.add(pa.array(values[at:end], arrow), starts)[0].to_pylist()
        at = end
    for i in range(n):
        run = [values[j] for j in range(i + 1) if keys[j] == keys[i]]
        known = [v for v in run if v is not None]
        assert got["count"][i] == len(known) and got["max"][i] == (max(known) if known else None)
        assert got["sum"][i] == exact(run, kind) and got["slide"][i] == exact(run[-size:], kind)


def close(a, b):
    """Equal, or doubles next to each other: a pair holds 106 bits, which may not break a tie between two."""
    return a == b or (isinstance(a, float) and isinstance(b, float) and abs(a - b) <= math.ulp(b))


def table(spark, kind, seed, n=400):
    """A key with a third of all rows, keys of one row, a NULL key, and rows in no order."""
    rnd = random.Random(seed)
    draw = VALUES[kind][1]
    rows = [(i * 3 - 200, "hot" if i % 3 == 0 else rnd.choice([None, *map(str, range(40))]),
             None if rnd.random() < 0.1 else draw(rnd)) for i in range(n)]
    rnd.shuffle(rows)
    return rows, spark.createDataFrame(rows, f"seq bigint, key string, value {kind}").repartition(3)


@pytest.mark.parametrize("kind", VALUES)
@pytest.mark.parametrize("n_parts", [1, 7, 97])
def test_running_over_many_partitions(spark, kind, n_parts):
    rows, df = table(spark, kind, 5)
    measures = {"total": (ordered.SUM, F.col("value")), "most": (ordered.MAX, F.col("value")), "no": (ordered.COUNT, F.lit(1))}
    with partitions(spark, n_parts):
        got = {(r.key, r.seq): r for r in ordered.running(df, ["key"], "seq", measures, SPLIT).collect()}
    assert len(got) == len(rows)
    for seq, key, _ in rows:
        run = [v for s, k, v in sorted(rows, key=lambda r: r[0]) if k == key and s <= seq]
        known = [v for v in run if v is not None]
        r = got[key, seq]
        assert r.no == len(run) and r.most == (max(known) if known else None) and close(r.total, exact(run, kind))


@pytest.mark.parametrize("kind", ["bigint", "decimal(10,2)"])
@pytest.mark.parametrize("n_parts, size, slide", [(7, 5, 2), (97, 5, 1), (97, 60, 1), (29, 400, 3), (13, 1, 1), (13, 2, 5)])
def test_windows_reach_over_short_partitions(spark, kind, n_parts, size, slide):
    """With 97 partitions of some four rows, a window of 60 rows looks back over fifteen of them."""
    rows, df = table(spark, kind, 6)
    with partitions(spark, n_parts):
        split = count_window_slide(df, ["key"], "seq", size, slide, "value", SPLIT).collect()
    want = {}
    for key in {k for _, k, _ in rows}:
        run = [(s, v) for s, k, v in sorted(rows, key=lambda r: r[0]) if k == key]
        for no in range(slide, len(run) + 1, slide):
            want[key, no] = (run[no - 1][0], exact([v for _, v in run[max(0, no - size):no]], kind))
    assert {(r.key, r.fired_at): (r.last_seq, r.total) for r in split} == want


def test_without_keys_and_without_rows(spark):
    rows, df = table(spark, "bigint", 7)
    with partitions(spark, 11):
        got = ordered.number_rows(df, [], "seq", "no", SPLIT).orderBy("seq").collect()
        assert [r.no for r in got] == list(range(1, len(rows) + 1))
        asked = [scan.Asked("n", "count", F.lit(1))]
        assert scan.with_earlier(scan.scan(df.limit(0), ["key"], "seq", asked), asked).count() == 0


def test_floating_sums_lose_nothing(spark):
    """Tiny and huge values, NaN and infinities; keys that are NaN are one key."""
    values = [1e-13, 1e30, -1e30, 1e-13, 2.0, float("inf"), 1.0, float("-inf"), 3.0]
    rows = [(i, float("nan"), v) for i, v in enumerate(values)] + [(i, 1.0, 0.1) for i in range(20)]
    df = spark.createDataFrame(rows, "seq bigint, key double, value double")
    for n_parts in (1, 5, 40):
        with partitions(spark, n_parts):
            got = ordered.running_sum(df, ["key"], "seq", "value").orderBy("seq").collect()
        odd = [r.total for r in got if r.key != r.key]
        assert odd[:5] == [1e-13, 1e30, 1e-13, 2e-13, 2.0000000000002]
        assert odd[5:7] == [math.inf, math.inf] and all(math.isnan(t) for t in odd[7:])
        assert [r.total for r in got if r.key == 1.0] == [float(sum([Fraction(0.1)] * i)) for i in range(1, 21)]


def test_sums_beyond_a_bigint_stop(spark):
    df = spark.createDataFrame([(i, "k", 1 << 62) for i in range(20)], "seq bigint, key string, value bigint")
    with pytest.raises(Exception, match="beyond a BIGINT"):
        ordered.running_sum(df, ["key"], "seq", "value", skew=SPLIT).collect()


def test_the_rows_are_exchanged_once(spark, monkeypatch):
    """One range exchange of the rows before the table, none after it."""
    _, df = table(spark, "bigint", 8)
    plans = []
    write = scan.run_dir

    def seen(session, name):
        plans.append(name)
        return write(session, name)

    monkeypatch.setattr(scan, "run_dir", seen)
    out = ordered.running_sum(df, ["key"], "seq", "value", skew=SPLIT)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plans == ["scan"] and "rangepartitioning" not in plan and "hashpartitioning" not in plan


def test_a_hot_key_is_spread_evenly(spark):
    df = spark.range(20_000).select((F.col("id") % 3 == 0).cast("string").alias("key"), F.col("id").alias("seq"))
    with partitions(spark, 20):
        found = scan.scan(df, ["key"], "seq", [scan.Asked("n", "count", F.lit(1))])
    assert len(found.parts) == 20 and max(p["n"] for p in found.parts) < 2000
