"""Micro-batch steps that carry rows from one batch to the next.

The batch operators split hot keys and give exact per-row results, which a streaming
aggregate does not. Here each micro-batch is run through the batch operator together
with the few rows of earlier batches that still matter. These carried rows are a table
in the shared folder, in two slots used in turn: batch b reads slot (b - 1) % 2 and
overwrites slot b % 2. Slot b - 1 stays as it is until batch b is committed, so a batch
that is run again starts from the same rows.

The carried table is written whole per batch, so this suits few or moderately many keys
and triggers of seconds or more; for very many keys the processors' state store is cheaper.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from rillrank import fixed
from rillrank.operators import ordered, windows
from rillrank.operators.alerts import alert_message, full_groups
from rillrank.operators.ordered import Skew
from rillrank.operators.ranking import top_n
from rillrank.streaming import sinks

CARRIED = "_carried"
BACK = "_back"


@dataclass(frozen=True)
class Step:
    """emit: results of carried and new rows; keep: the rows the next batch needs, with
    ``_back`` = 1 for the last of a key, 2 for the one before it, and so on."""

    emit: Callable[[DataFrame], DataFrame]
    keep: Callable[[DataFrame], DataFrame]
    # A column whose carried rows hold a total, which needs a wider type.
    total: str | None = None


def start(df: DataFrame, step: Step, order: str, path: str, carry_path: str, checkpoint: str,
          every: str | None = fixed.CHECKPOINT_INTERVAL, persist: bool = True, place: str | None = None) -> StreamingQuery:
    """Rows of later batches follow all rows of earlier ones, as they arrived.

    ``place`` names a column that orders the rows of a batch but is no number: each batch's rows are then numbered
    by it, from 1, and ``order`` is that number. Rows of one place must lie in one partition, in their order.

    A batch is read several times. ``persist`` keeps it for that, which pays for a broker;
    for columnar files of any number reading again is the better choice.
    """
    schema = df.schema if place is None else T.StructType(
        [*[f for f in df.schema.fields if f.name != place], T.StructField(order, T.LongType())])

    def write(batch: DataFrame, batch_id: int) -> None:
        if place is not None:
            exact = batch.withColumn(place, F.struct(place, F.monotonically_increasing_id()))
            batch = ordered.number_rows(exact, [], place, order).drop(place)
        if persist:
            batch.persist()
        try:
            rows = _with_carried(batch.sparkSession, batch, _stored(schema, step.total), order, carry_path, batch_id)
            emitted = step.emit(rows)
            same = [F.col(c).cast(schema[c].dataType).alias(c) if c in schema.names else c for c in emitted.columns]
            emitted.select(*same).write.mode("overwrite").parquet(sinks.batch_path(path, batch_id))
            kept = step.keep(rows).select(*schema.names, BACK)
            kept.write.mode("overwrite").parquet(_slot(carry_path, batch_id))
        finally:
            if persist:
                batch.unpersist()

    return sinks.start(df, write, checkpoint, every=every)


def _stored(schema: T.StructType, total: str | None) -> T.StructType:
    """The schema of carried rows: a total has the type that a sum of the column has."""
    def of(f: T.StructField) -> T.StructField:
        kind = f.dataType
        if f.name == total:
            kind = (T.LongType() if isinstance(kind, T.IntegralType) else T.DecimalType(38, kind.scale)
                    if isinstance(kind, T.DecimalType) else T.DoubleType())
        return T.StructField(f.name, kind, True)
    return T.StructType([of(f) for f in schema.fields])


def _slot(carry_path: str, batch_id: int) -> str:
    return f"{carry_path}/slot={batch_id % 2}"


def _with_carried(spark: SparkSession, batch: DataFrame, schema: T.StructType, order: str,
                  carry_path: str, batch_id: int) -> DataFrame:
    fresh = batch.withColumn(CARRIED, F.lit(False))
    if batch_id == 0:
        return fresh
    stored = T.StructType([*schema.fields, T.StructField(BACK, T.LongType())])
    first = batch.agg(F.min(order)).first()[0]
    # Carried rows come before every row of this batch, in their own order.
    place = F.lit(0 if first is None else first) - F.col(BACK)
    carried = (
        spark.read.schema(stored).parquet(_slot(carry_path, batch_id - 1))
        .withColumn(order, place.cast(schema[order].dataType)).drop(BACK)
        .withColumn(CARRIED, F.lit(True))
    )
    return fresh.unionByName(carried)


def running_sum(keys: list[str], order: str, value: str, out: str = "total", skew: Skew = Skew()) -> Step:
    """Per input row, the total of its key so far, over all batches."""
    return _running(keys, order, value, out, ordered.SUM, F.sum, skew, value)


def running_max(keys: list[str], order: str, value: str, out: str = "largest", skew: Skew = Skew()) -> Step:
    return _running(keys, order, value, out, ordered.MAX, F.max, skew)


def _running(keys, order, value, out, measure, aggregate, skew, total=None) -> Step:
    def emit(rows: DataFrame) -> DataFrame:
        totals = ordered.running(rows, keys, order, {out: (measure, F.col(value))}, skew)
        return totals.filter(~F.col(CARRIED)).drop(CARRIED)

    def keep(rows: DataFrame) -> DataFrame:
        others = [c for c in rows.columns if c not in (*keys, value, CARRIED)]
        return rows.groupBy(*keys).agg(
            aggregate(value).alias(value),
            *[F.max(c).alias(c) for c in others],
        ).withColumn(BACK, F.lit(1).cast("bigint"))

    return Step(emit, keep, total)


def _short_groups(rows: DataFrame, keys: list[str], order: str, size: int, skew: Skew) -> DataFrame:
    """The rows of unfinished groups: fewer than ``size`` per key."""
    columns = [c for c in rows.columns if c not in (CARRIED, *keys)]
    lists = (
        ordered.consecutive_groups(rows, keys, order, size, skew).groupBy(*keys, "_group")
        .agg(F.sort_array(F.collect_list(F.struct("_no", *columns))).alias("_rows"))
        .filter(F.size("_rows") < size)
    )
    spread = lists.select(*keys, F.size("_rows").alias("_n"), F.posexplode("_rows").alias("_pos", "_row"))
    return spread.select(
        *keys, *[F.col(f"_row.{c}").alias(c) for c in columns], (F.col("_n") - F.col("_pos")).cast("bigint").alias(BACK)
    )


def threshold_alerts(threshold: float = fixed.ALERT_THRESHOLD, times: int = fixed.ALERT_TIMES, key: str = "key",
                     order: str = "seq", value: str = "value", skew: Skew = Skew()) -> Step:
    """Alert every ``times`` breaches of a key; a hot key is split like in the batch operator."""
    def breaches(rows: DataFrame) -> DataFrame:
        return rows.filter(F.col(value) >= threshold)

    def emit(rows: DataFrame) -> DataFrame:
        return full_groups(breaches(rows), times, key, order, value, skew).select(
            F.col(key).alias("key"), "last_seq", alert_message(key).alias("message"), "abnormal_values"
        )

    return Step(emit, lambda rows: _short_groups(breaches(rows), [key], order, times, skew))


def count_window_all(order: str, size: int, value: str, skew: Skew = Skew()) -> Step:
    """Sums of every ``size`` consecutive rows of the stream, in one numbering over all tasks."""
    def emit(rows: DataFrame) -> DataFrame:
        return windows.count_window_all(rows, order, size, value, skew).drop("window_no")

    return Step(emit, lambda rows: _short_groups(rows, [], order, size, skew))


def count_window_slide(keys: list[str], order: str, size: int, slide: int, value: str, skew: Skew = Skew()) -> Step:
    """At every ``slide``-th row of a key, the sum of its last ``size`` rows."""
    def emit(rows: DataFrame) -> DataFrame:
        # fired_at counts from the carried rows on, not from the first row of the key.
        return windows.count_window_slide(
            rows, keys, order, size, slide, value, skew, CARRIED
        ).drop("fired_at")

    def keep(rows: DataFrame) -> DataFrame:
        # So many of the last rows that every window still to come is complete, and that
        # their count agrees with the key's count modulo the slide.
        numbered = ordered.number_rows(rows, keys, order, "_no", skew)
        # The tie is the order itself: it also deals a hot key over the parts of a large cut.
        last = top_n(numbered, keys, F.col(order), order, size + slide, BACK)
        total = F.col("_no") + F.col(BACK) - 1
        needed = size - 1 + F.pmod(total - (size - 1), F.lit(slide))
        return last.filter(F.col(BACK) <= needed).withColumn(BACK, F.col(BACK).cast("bigint"))

    return Step(emit, keep)
