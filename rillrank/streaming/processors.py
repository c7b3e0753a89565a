"""Stateful processors for transformWithState: alerts, sliding count windows, window-end timers.

State per key is bounded by the operator (fewer than ``times`` values, fewer than ``size``
values, ``n`` rows). Input reaches a key as batches of columns; what is sorted at once is
one key's rows of one micro-batch. Rows of a later micro-batch must follow in ``seq``; a row that
goes back stops the query. For keys with very many rows in a micro-batch use ``carry``, which
splits them over tasks.
"""

from __future__ import annotations

import heapq
import sys
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from rillrank import fixed
from rillrank.operators.alerts import alert_message


# Processors travel with their code, so that workers need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Columns on their way to a processor must not start with an underscore: they would arrive renamed.


def _in_order(rows: Iterator[pd.DataFrame], newest) -> dict[str, np.ndarray]:
    """The columns of a key's rows by ``seq``. Rows that come after later ones were already used are refused:
    what they should have changed is out."""
    whole = pd.concat(list(rows)).sort_values("seq", kind="stable")
    columns = {c: whole[c].to_numpy() for c in whole.columns}
    if newest.exists() and columns["seq"][0] <= newest.get()[0]:
        raise ValueError(f"row {columns['seq'][0]} comes after row {newest.get()[0]} of its key was used")
    newest.update((int(columns["seq"][-1]),))
    return columns


class EveryNthBreach(StatefulProcessor):
    """Holds a key's breaches until there are ``times`` of them."""

    def __init__(self, times: int, value_type: str):
        self.times = times
        self.value_type = value_type

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.pending = handle.getListState("pending", f"value {self.value_type}")
        self.newest = handle.getValueState("newest", "seq bigint")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        columns = _in_order(rows, self.newest)
        seq, values = columns["seq"], columns["value"]
        held = [v for (v,) in self.pending.get()]
        values = np.concatenate([np.asarray(held, dtype=values.dtype), values])
        full = len(values) // self.times
        rest = values[full * self.times:]
        if len(rest):
            self.pending.put([(v.item(),) for v in rest])
        elif held:
            self.pending.clear()
        if full:
            ends = np.arange(1, full + 1) * self.times - 1 - len(held)
            yield pd.DataFrame({
                "key": [key[0]] * full,
                "last_seq": seq[ends],
                "abnormal_values": list(values[: full * self.times].reshape(full, self.times)),
            })

    def close(self) -> None:
        pass


class SlidingCount(StatefulProcessor):
    """Sums the last ``size`` values of a key at every ``slide``-th row. NULLs add nothing; a window of
    NULLs only has no total."""

    def __init__(self, size: int, slide: int, value_type: str):
        self.size = size
        self.slide = slide
        self.value_type = value_type

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.last = handle.getListState("last", f"value {self.value_type}, known int")
        self.seen = handle.getValueState("seen", "rows bigint")
        self.newest = handle.getValueState("newest", "seq bigint")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        columns = _in_order(rows, self.newest)
        seq, values, known = columns["seq"], columns["value"], columns["known"]
        seen = self.seen.get()[0] if self.seen.exists() else 0
        held = list(self.last.get())
        window = np.concatenate([np.array([v for v, _ in held], dtype=values.dtype), values])
        in_window = np.concatenate([np.array([k for _, k in held], dtype=known.dtype), known])
        # Rows are numbered from 1 over the key's life; row r is window[r - seen - 1 + len(held)].
        numbers = np.arange(seen + 1, seen + len(values) + 1)
        fired = numbers[numbers % self.slide == 0]
        ends = fired - seen + len(held)
        self.seen.update((int(seen + len(values)),))
        if self.size > 1:
            keep = slice(-(self.size - 1), None)
            self.last.put([(v.item(), k.item()) for v, k in zip(window[keep], in_window[keep], strict=True)])
        if len(fired):
            counts = self._totals(in_window, ends)
            totals = pd.Series(self._totals(window, ends), dtype=object).where(counts > 0, None)
            yield pd.DataFrame({
                "key": [key[0]] * len(fired), "fired_at": fired,
                "last_seq": seq[fired - seen - 1], "total": totals,
            })

    def _totals(self, values: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Sums of the last ``size`` values before each end. Differences of running sums are exact for
        integers only."""
        if np.issubdtype(values.dtype, np.integer):
            sums = np.concatenate([[0], np.cumsum(values)])
            return sums[ends] - sums[np.maximum(0, ends - self.size)]
        padded = np.concatenate([np.zeros(self.size, values.dtype), values])
        views = np.lib.stride_tricks.sliding_window_view(padded, self.size)
        return np.array([views[end].sum() for end in ends])

    def close(self) -> None:
        pass


class BestAtWindowEnd(StatefulProcessor):
    """Holds the ``n`` best rows of a window (or of a part of it) and gives them out by an
    event-time timer one millisecond after its end."""

    def __init__(self, n: int, by: list[str], tie: str, columns: list[str], schema: str):
        self.n = n
        self.by = [columns.index(c) for c in by]
        self.tie = columns.index(tie)
        self.columns = columns
        self.schema = schema

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.best = handle.getListState("best", self.schema)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        held = list(self.best.get())
        for part in rows:
            fresh = zip(*(part[c].tolist() for c in self.columns))
            held = heapq.nsmallest(self.n, chain(held, fresh), key=self._place)
        self.best.put(held)
        self.handle.registerTimer(int(key[0]) + 1)
        return iter([])

    def _place(self, row: tuple) -> tuple:
        return -sum(row[i] for i in self.by), row[self.tie]

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        held = pd.DataFrame(list(self.best.get()), columns=self.columns)
        self.best.clear()
        yield held.assign(window_end_ms=int(key[0]))

    def close(self) -> None:
        pass


def threshold_alerts(df: DataFrame, threshold: float = fixed.ALERT_THRESHOLD, times: int = fixed.ALERT_TIMES,
                     key: str = "key", order: str = "seq", value: str = "value") -> DataFrame:
    """Stream of alerts, one per ``times`` breaches of a key; only breaches are shuffled."""
    if times < 1:
        raise ValueError("times must be at least 1")
    types = {f.name: f.dataType for f in df.schema}
    breaches = df.filter(F.col(value) >= threshold).select(
        F.col(key).alias("key"), F.col(order).alias("seq"), F.col(value).alias("value")
    )
    out = T.StructType([
        T.StructField("key", types[key]), T.StructField("last_seq", types[order]),
        T.StructField("abnormal_values", T.ArrayType(types[value])),
    ])
    found = breaches.groupBy("key").transformWithStateInPandas(
        EveryNthBreach(times, types[value].simpleString()), out, "append", "none"
    )
    return found.select("key", "last_seq", alert_message("key").alias("message"), "abnormal_values")


def count_window_slide(df: DataFrame, key: str, order: str, size: int, slide: int, value: str) -> DataFrame:
    """Totals are BIGINT for integral values, else DOUBLE."""
    types = {f.name: f.dataType for f in df.schema}
    total = T.LongType() if isinstance(types[value], T.IntegralType) else T.DoubleType()
    number = F.col(value).cast(total)
    rows = df.select(F.col(key).alias("key"), F.col(order).alias("seq"), F.coalesce(number, F.lit(0).cast(total)).alias("value"),
                     F.col(value).isNotNull().cast("int").alias("known"))
    out = T.StructType([
        T.StructField("key", types[key]), T.StructField("fired_at", T.LongType()),
        T.StructField("last_seq", types[order]), T.StructField("total", total),
    ])
    return rows.groupBy("key").transformWithStateInPandas(
        SlidingCount(size, slide, total.simpleString()), out, "append", "none"
    )


def best_at_window_end(windowed: DataFrame, n: int, by: list[str], tie: str, columns: list[str],
                       parts: int) -> DataFrame:
    """The ``n`` best rows of each part of a window, one millisecond after the window's end.

    ``windowed`` is a streaming aggregate with its ``window``. A window's rows are spread
    over ``parts`` by a hash of ``tie``; rank the result per ``window_end_ms`` for the final N.
    Rows are ordered by the sum of the columns ``by``.
    """
    types = {f.name: f.dataType for f in windowed.schema}
    fields = [T.StructField(c, types[c]) for c in columns]
    rows = windowed.select(
        F.unix_millis(F.col("window.end")).alias("window_end_ms"),
        F.pmod(F.xxhash64(tie), F.lit(parts)).alias("part"), F.window_time("window").alias("emitted_at"), *columns,
    )
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in fields)
    out = T.StructType([*fields, T.StructField("window_end_ms", T.LongType())])
    return rows.groupBy("window_end_ms", "part").transformWithStateInPandas(
        BestAtWindowEnd(n, by, tie, columns, schema), out, "append", "EventTime"
    )
