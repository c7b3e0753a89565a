"""Parallel prefix scan: running aggregates and sliding sums of keys of any size, with one exchange of the rows.

Rows are range-partitioned by (keys, order), so a key may go on over any number of partitions, each as large
as any other. A task runs once over its sorted rows and adds what it knows: running values from its first row
on, and sums of the last `size` rows. What a key brings along from earlier partitions concerns only the first
run of a partition, and is one row per partition: those are summed up on the driver, whose work is bounded by
the number of partitions, and added to the first runs. Sliding sums need rows, not totals: the first rows of a
continued run get the last `size - 1` rows before it, in a window over those few rows alone.

The sorted rows with their local values are a table in the shared folder, so nothing is partitioned or
computed twice when an executor is lost.

Sums of integers and decimals are exact; one beyond a BIGINT stops the query. Sums of floating values are added
without rounding inside a partition and as pairs of doubles (106 bits) across them, so that a key's total does not
depend on how it is split; NaN and infinities do what they do in any sum.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rillrank.session import run_dir

PART, RUN, ROW, PLACE = "_part", "_run", "_row", "_place"

#: Doubles as integers: every finite one is a multiple of 2**-_SCALE.
_SCALE = 1127


@dataclass(frozen=True)
class Asked:
    """One column to compute: `kind` is sum, max, count or slide (the sum of the last `size` rows)."""

    name: str
    kind: str
    value: Column
    size: int = 0


@dataclass(frozen=True)
class Scanned:
    """Sorted rows with the local value of each asked column, `_part`, the run of a key in it, the row in the part
    and its place in the run (from 1); `parts` holds a dict per part in order."""

    rows: DataFrame
    keys: list[str]
    parts: list[dict]


def _pair(name: str) -> str:
    return f"{name}_low"


def scan(df: DataFrame, keys: list[str], order: str, asked: list[Asked]) -> Scanned:
    """Runs over the rows of `df` once. Their columns and the names asked for must not clash."""
    spark = df.sparkSession
    values = df.withColumns({f"_v{i}": a.value for i, a in enumerate(asked)})
    results = [df.select(_result(a).alias(a.name)).schema[0] for a in asked]
    # Sums of floating values are pairs.
    pairs = [a.name for a, f in zip(asked, results) if a.kind == "sum" and isinstance(f.dataType, T.DoubleType)]
    schema = T.StructType([
        *df.schema.fields, *[T.StructField(f.name, f.dataType) for f in results],
        *[T.StructField(_pair(n), T.DoubleType()) for n in pairs],
        T.StructField(PART, T.IntegerType()), T.StructField(RUN, T.LongType()), T.StructField(ROW, T.LongType()),
        T.StructField(PLACE, T.LongType()),
    ])
    task = _Task(df.columns, keys, [(f"_v{i}", a.kind, a.size, a.name in pairs) for i, a in enumerate(asked)])
    ranged = values.repartitionByRange(*keys, order).sortWithinPartitions(*keys, order)
    path = run_dir(spark, "scan")
    ranged.mapInArrow(task.run, schema).write.parquet(path)
    rows = spark.read.schema(schema).parquet(path)
    computed = [f.name for f in results] + [_pair(n) for n in pairs]
    of_parts = rows.groupBy(PART).agg(
        F.min_by(F.struct(*keys, RUN), ROW).alias("first"), F.max_by(F.struct(*keys, RUN, PLACE), ROW).alias("last"),
        F.max_by(F.struct(*computed), ROW).alias("totals"), F.count("*").alias("n"))
    parts = [{"part": r[PART], "first": tuple(r["first"])[:len(keys)], "last": tuple(r["last"])[:len(keys)], "run": r["last"][RUN],
              "place": r["last"][PLACE], "n": r["n"], "totals": r["totals"].asDict()}
             for r in of_parts.orderBy(PART).collect()]
    return Scanned(rows, keys, parts)


def _result(a: Asked) -> Column:
    if a.kind == "max":
        return F.max(a.value)
    return F.count(a.value) if a.kind == "count" else F.sum(a.value)


def _same(a: tuple, b: tuple) -> bool:
    """Keys as a grouping sees them: NULL is NULL and NaN is NaN."""
    return all(x == y or (isinstance(x, float) and isinstance(y, float) and x != x and y != y) for x, y in zip(a, b))


def with_earlier(scanned: Scanned, asked: list[Asked]) -> DataFrame:
    """The rows with the asked columns of the whole key: what earlier partitions hold is added to first runs."""
    names = {a.name: a.kind for a in asked if a.kind != "slide"}
    brought, now, key = [], None, None
    for part in scanned.parts:
        before = now if now is not None and _same(key, part["first"]) else None
        if before is not None:
            brought.append((part["part"], before))
        own = part["totals"]
        one_run = part["run"] == 0
        now = {n: _together(k, n, before, own) for n, k in names.items()} if before is not None and one_run else {
            n: (own[n], own.get(_pair(n), 0.0)) for n in names}
        key = part["last"]
    rows = scanned.rows
    pairs = [n for n in names if _pair(n) in rows.columns]
    if brought:
        fields = [T.StructField("_p", T.IntegerType()), *[T.StructField(f"_b_{n}", rows.schema[n].dataType) for n in names],
                  *[T.StructField(f"_b_{_pair(n)}", T.DoubleType()) for n in pairs]]
        side = rows.sparkSession.createDataFrame(
            [(p, *[b[n][0] for n in names], *[b[n][1] for n in pairs]) for p, b in brought], T.StructType(fields))
        # At most one row per partition.
        rows = rows.join(F.broadcast(side), (F.col(PART) == F.col("_p")) & (F.col(RUN) == 0), "left")
        rows = rows.withColumns({n: _combined(k, n, n in pairs) for n, k in names.items()})
    return rows.drop("_p", *[f"_b_{n}" for n in names], *[f"_b_{_pair(n)}" for n in pairs], *[_pair(n) for n in pairs])


def _together(kind: str, name: str, before: dict, own: dict) -> tuple:
    """A total and the rest of its pair, of what came before and a partition's own."""
    (a, low), b = before[name], own[name]
    if a is None or b is None:
        return (a, low) if b is None else (b, own.get(_pair(name), 0.0))
    if kind == "max":
        return (a if a != a or a > b else b), 0.0
    if isinstance(b, float):
        return _add_pairs(a, low, b, own[_pair(name)])
    return a + b, 0.0


def _add_pairs(a: float, a_low: float, b: float, b_low: float) -> tuple[float, float]:
    if not (math.isfinite(a) and math.isfinite(b)):
        return a + b, 0.0
    total = math.fsum((a, a_low, b, b_low))
    return total, math.fsum((a, a_low, b, b_low, -total))


def _combined(kind: str, name: str, pair: bool) -> Column:
    here, before = F.col(name), F.col(f"_b_{name}")
    if kind == "max":
        return F.greatest(here, before)
    if not pair:
        return F.coalesce(here + before, here, before)
    total = here + before
    back = total - here
    error = (here - (total - back)) + (before - back) + F.col(_pair(name)) + F.col(f"_b_{_pair(name)}")
    return F.coalesce(F.when(F.isnan(error), total).otherwise(total + error), here, before)


def slide_over_parts(scanned: Scanned, name: str, value: str, size: int) -> DataFrame:
    """The rows with the sums of the last `size` rows of the key, also where those lie in earlier partitions.

    `value` is the column summed. A row needs others' rows only if its place in the first run is below `size`.
    """
    targets = _targets(scanned.parts, size)
    reached = sorted({t for ts in targets.values() for t in ts})
    rows = scanned.rows
    if not reached:
        return rows
    spark = rows.sparkSession
    parts = {p["part"]: p for p in scanned.parts}
    side = spark.createDataFrame([(p, parts[p]["run"], parts[p]["n"], ts) for p, ts in targets.items()],
                                 "_p INT, _last_run BIGINT, _n BIGINT, _to ARRAY<INT>")
    marks = spark.createDataFrame([(t, True) for t in reached], "_q INT, _reached BOOLEAN")
    marked = rows.join(F.broadcast(marks), F.col(PART) == F.col("_q"), "left").drop("_q")
    head = F.coalesce(F.col("_reached") & (F.col(RUN) == 0) & (F.col(PLACE) < size), F.lit(False))
    whole = marked.where(~head).drop("_reached")
    heads = marked.where(head).drop("_reached").withColumns({"_to": F.col(PART), "_head": F.lit(True)})
    # The last rows of a partition's last run go to the partitions that need them, mostly the next one.
    tails = (
        rows.join(F.broadcast(side), (F.col(PART) == F.col("_p")) & (F.col(RUN) == F.col("_last_run")))
        .where(F.col("_n") - F.col(ROW) < size).drop("_p", "_last_run", "_n")
        .withColumn("_to", F.explode("_to")).withColumn("_head", F.lit(False))
    )
    last = Window.partitionBy("_to").orderBy(PART, ROW).rowsBetween(1 - size, Window.currentRow)
    mended = heads.unionByName(tails).withColumn(name, F.sum(value).over(last)).where("_head").drop("_to", "_head")
    return whole.unionByName(mended)


def _targets(parts: list[dict], size: int) -> dict[int, list[int]]:
    """For each partition the later ones whose first rows look back into it."""
    out: dict[int, list[int]] = {}
    for i, part in enumerate(parts):
        between, to = 0, []
        for later in parts[i + 1:]:
            if between >= size - 1 or not _same(part["last"], later["first"]):
                break
            to.append(later["part"])
            if later["run"] != 0:  # another key follows
                break
            between += later["n"]
        if to:
            out[part["part"]] = to
    return out


class _Task:
    """Runs over the sorted rows of one partition, batch by batch."""

    def __init__(self, columns: list[str], keys: list[str], asked: list[tuple[str, str, int, bool]]):
        self.columns, self.keys, self.asked = columns, keys, asked

    def run(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        steps = [_STEPS[kind](size) if kind != "sum" else _Sum(pair) for _, kind, size, pair in self.asked]
        last, runs, seen, place = None, -1, 0, 0
        for batch in batches:
            if not len(batch):
                continue
            new = self._new_runs(batch, last)
            last = batch.slice(len(batch) - 1, 1)
            starts = np.flatnonzero(new)
            run = runs + np.cumsum(new)
            here = _places(starts, len(batch), place)
            out, lows = [], []
            for step, (column, *_) in zip(steps, self.asked):
                found = step.add(batch.column(column), starts)
                out.append(found[0])
                lows += found[1:]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in self.columns], *out, *lows, pa.array(np.full(len(batch), part, np.int32)),
                 pa.array(run), pa.array(np.arange(seen, seen + len(batch))), pa.array(here)],
                [str(i) for i in range(len(self.columns) + len(out) + len(lows) + 4)],
            )
            runs, seen, place = int(run[-1]), seen + len(batch), int(here[-1])

    def _new_runs(self, batch: pa.RecordBatch, last: pa.RecordBatch | None) -> np.ndarray:
        new = np.zeros(len(batch), bool)
        new[0] = last is None
        for key in self.keys:
            column = batch.column(key)
            if last is None:
                a, b, at = column.slice(0, len(column) - 1), column.slice(1), 1
            else:
                a, b, at = pa.concat_arrays([last.column(key), column.slice(0, len(column) - 1)]), column, 0
            same = pc.fill_null(pc.equal(a, b), False)
            same = pc.or_(same, pc.and_(a.is_null(), b.is_null()))
            if pa.types.is_floating(column.type):
                same = pc.or_(same, pc.fill_null(pc.and_(pc.is_nan(a), pc.is_nan(b)), False))
            new[at:] |= ~np.asarray(same)
        return new


def _places(starts: np.ndarray, n: int, before: int) -> np.ndarray:
    """The place of each row in its run; rows before the first start go on after `before` rows."""
    return _since(np.arange(1, n + 1), starts, before)


def _pieces(starts: np.ndarray, n: int) -> Iterator[tuple[int, int, bool]]:
    """(begin, end, whether a run begins there) of the pieces of a batch that lie in one run."""
    edges = [*([0] if not len(starts) or starts[0] else []), *starts.tolist(), n]
    begins = set(starts.tolist())
    for a, b in zip(edges, edges[1:]):
        yield a, b, a in begins


def _since(total: np.ndarray, starts: np.ndarray, carried) -> np.ndarray:
    """Cumulative sums of a batch turned into sums since the run's start; `carried` is the open run's sum so far."""
    edges = [*([0] if not len(starts) or starts[0] else []), *starts.tolist()]
    # What a piece's sums are too high by: the sum before it, or too low by: the open run's.
    bases = [total[e - 1] if e else total[0] * 0 for e in edges]
    if not len(starts) or starts[0]:
        bases[0] = bases[0] - carried
    return total - np.repeat(np.array(bases, dtype=total.dtype), np.diff([*edges, len(total)]))


def _numbers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Values with 0 for NULL, and which are not NULL. Decimals and floating values become exact integers' objects."""
    valid = np.asarray(column.is_valid())
    if pa.types.is_integer(column.type):
        return np.asarray(column.fill_null(0)).astype(np.int64), valid
    return np.array([0 if v is None else v for v in column.to_pylist()], dtype=object), valid


def _exact(values: np.ndarray) -> np.ndarray:
    """Finite doubles as integers, times 2**_SCALE; 0 for the others."""
    finite = np.isfinite(values)
    mantissa, exponent = np.frexp(np.where(finite, values, 0.0))
    whole = (mantissa * 2.0 ** 53).astype(np.int64)
    return np.array([m << (e + _SCALE - 53) for m, e in zip(whole.tolist(), exponent.tolist())], dtype=object)


def _double(total: int) -> float:
    try:
        return total / (1 << _SCALE)
    except OverflowError:
        return math.inf if total > 0 else -math.inf


class _Sum:
    """Running sums. Those of floating values come with what rounding took away, if `pair`."""

    def __init__(self, pair: bool = False):
        self.pair, self.total, self.odd, self.known = pair, 0, 0.0, 0

    def add(self, column: pa.Array, starts: np.ndarray) -> list[pa.Array]:
        valid = np.asarray(column.is_valid())
        count = _since(np.cumsum(valid), starts, self.known)
        self.known = int(count[-1])
        if not pa.types.is_floating(column.type):
            values, _ = _numbers(column)
            out = _since(np.cumsum(values), starts, self.total)
            if values.dtype != object:
                rough = _since(np.cumsum(values.astype(np.float64)), starts, float(self.total))
                if np.abs(rough).max() > 2.0 ** 63:
                    raise OverflowError("a sum is beyond a BIGINT")
            self.total = out[-1] if values.dtype == object else int(out[-1])
            return [pa.array(out, mask=count == 0) if values.dtype != object else
                    pa.array([v if k else None for v, k in zip(out, count)], _wider(column.type))]
        values = np.asarray(column.cast(pa.float64()).fill_null(0.0))
        exact = _since(np.cumsum(_exact(values)), starts, self.total)
        odd = np.where(np.isfinite(values), 0.0, values)
        for a, b, begins in _pieces(starts, len(values)):
            odd[a] += 0.0 if begins else self.odd
            odd[a:b] = np.cumsum(odd[a:b])
            self.odd = float(odd[b - 1])
        self.total = exact[-1]
        high = np.array([_double(t) for t in exact])
        rest = [t - (_exact_one(h)) if math.isfinite(h) else 0 for t, h in zip(exact, high.tolist())]
        low = np.array([_double(t) for t in rest])
        strange = odd != 0
        high, low = np.where(strange, odd, high), np.where(strange, 0.0, low)
        empty = count == 0
        return [pa.array(high, mask=empty), pa.array(low, mask=empty)]


def _exact_one(value: float) -> int:
    top, bottom = value.as_integer_ratio()
    return top * ((1 << _SCALE) // bottom)


def _wider(kind: pa.DataType) -> pa.DataType:
    """The type that a sum of decimals has."""
    return pa.decimal128(min(38, kind.precision + 10), kind.scale)


class _Count:
    def __init__(self, _: int = 0):
        self.known = 0

    def add(self, column: pa.Array, starts: np.ndarray) -> list[pa.Array]:
        out = _since(np.cumsum(np.asarray(column.is_valid())), starts, self.known)
        self.known = int(out[-1])
        return [pa.array(out)]


class _Max:
    """Running maxima of any ordered type; NaN is the largest."""

    def __init__(self, _: int = 0):
        self.best = None

    def add(self, column: pa.Array, starts: np.ndarray) -> list[pa.Array]:
        if pa.types.is_integer(column.type):
            return [self._integers(column, starts)]
        out, begins, best = [], set(starts.tolist()), self.best
        for i, v in enumerate(column.to_pylist()):
            if i in begins:
                best = None
            if v is not None and (best is None or v != v or (best == best and v > best)):
                best = v
            out.append(best)
        self.best = best
        return [pa.array(out, column.type)]

    def _integers(self, column: pa.Array, starts: np.ndarray) -> pa.Array:
        least = np.iinfo(np.int64).min
        valid = np.asarray(column.is_valid())
        values = np.where(valid, np.asarray(column.fill_null(0)).astype(np.int64), least)
        known = valid.copy()
        for a, b, begins in _pieces(starts, len(values)):
            if not begins and self.best is not None:
                values[a], known[a] = max(int(values[a]), self.best), True
            values[a:b] = np.maximum.accumulate(values[a:b])
            known[a:b] = np.logical_or.accumulate(known[a:b])
            self.best = int(values[b - 1]) if known[b - 1] else None
        return pa.array(np.where(known, values, 0), mask=~known).cast(column.type)


class _Slide:
    """Sums of the last `size` rows of a run; NULL if all of them are."""

    def __init__(self, size: int):
        self.size, self.held = size, None

    def add(self, column: pa.Array, starts: np.ndarray) -> list[pa.Array]:
        floating = pa.types.is_floating(column.type)
        kind = pa.float64() if floating else _wider(column.type) if pa.types.is_decimal(column.type) else pa.int64()
        # Rows of the open run that a window of this batch can still reach stand in front.
        whole = column if self.held is None else pa.concat_arrays([self.held, column])
        front = len(whole) - len(column)
        if floating:
            raw = np.asarray(whole.cast(pa.float64()).fill_null(0.0))
            values, valid = _exact(raw), np.asarray(whole.is_valid())
        else:
            values, valid = _numbers(whole)
            raw = None
        rows = np.arange(front, len(whole))
        first = np.zeros(len(column), np.int64)
        first[starts] = starts + front
        begin = np.maximum(np.maximum.accumulate(first), rows - self.size + 1)
        window = lambda x: _differences(x, begin, rows)
        total, known = window(values), window(valid.astype(np.int64))
        keep = min(self.size - 1, len(whole) - int(np.maximum.accumulate(first)[-1]))
        self.held = whole.slice(len(whole) - keep) if keep else None
        if raw is not None:
            out = np.array([_double(t) for t in total])
            if not np.isfinite(raw).all():
                nan, high, low = (window(x.astype(np.int64)) for x in (np.isnan(raw), raw == np.inf, raw == -np.inf))
                out = np.where(high > 0, np.inf, np.where(low > 0, -np.inf, out))
                out = np.where((nan > 0) | ((high > 0) & (low > 0)), np.nan, out)
            return [pa.array(out, mask=known == 0)]
        if total.dtype == object:
            return [pa.array([Decimal(t) if k else None for t, k in zip(total, known)], kind)]
        return [pa.array(total, mask=known == 0)]


def _differences(values: np.ndarray, begin: np.ndarray, rows: np.ndarray) -> np.ndarray:
    sums = np.concatenate([values[:1] * 0, np.cumsum(values)])
    return sums[rows + 1] - sums[begin]


_STEPS = {"count": _Count, "max": _Max, "slide": _Slide}
