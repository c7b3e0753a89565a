"""Starting streams: checkpoints, triggers, and sinks that a replayed batch cannot double."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from rillrank import fixed

BATCH = "batch_id"

BatchWriter = Callable[[DataFrame, int], None]


def start(df: DataFrame, write: BatchWriter, checkpoint: str, mode: str = "append",
          every: str | None = fixed.CHECKPOINT_INTERVAL) -> StreamingQuery:
    """Runs ``write(batch, batch_id)`` per micro-batch with progress kept in ``checkpoint``.

    A batch that failed half-way is run again under its id. ``every=None`` processes what
    is there and stops.
    """
    writer = df.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).foreachBatch(write)
    trigger = {"processingTime": every} if every else {"availableNow": True}
    return writer.trigger(**trigger).start()


def batch_path(path: str, batch_id: int) -> str:
    return f"{path}/{BATCH}={batch_id}"


def to_files(path: str, shape: Callable[[DataFrame], DataFrame] = lambda df: df, show: bool = False) -> BatchWriter:
    """Writes each batch to its own folder; a replay overwrites the folder. ``show`` prints what was written."""
    def write(batch: DataFrame, batch_id: int) -> None:
        shape(batch).write.mode("overwrite").parquet(batch_path(path, batch_id))
        if show:
            to_console()(batch.sparkSession.read.parquet(batch_path(path, batch_id)), batch_id)
    return write


def to_console(shape: Callable[[DataFrame], DataFrame] = lambda df: df) -> BatchWriter:
    """Prints every row where it is computed: in the executors' output, which is the console of a local master."""
    def write(batch: DataFrame, batch_id: int) -> None:
        shape(batch).withColumn(BATCH, F.lit(batch_id)).foreachPartition(_print_rows)
    return write


def _print_rows(rows: Iterator) -> None:
    for row in rows:
        print(row, flush=True)


def to_alert_files(path: str, shape: Callable[[DataFrame], DataFrame] = lambda df: df) -> BatchWriter:
    """The alert channel: a table of its own, apart from the results."""
    return to_files(path, lambda df: shape(df).withColumn("alerted_at", F.current_timestamp()))


def read_batches(spark: SparkSession, path: str) -> DataFrame:
    """What ``to_files`` has written, with the ``batch_id`` of each row."""
    return spark.read.parquet(path)


def latest_updates(updates: DataFrame, keys: list[str]) -> DataFrame:
    """The last state of each key from the rows of an update-mode stream."""
    values = [c for c in updates.columns if c not in (*keys, BATCH)]
    last = F.max_by(F.struct(*values), BATCH).alias("_last")
    return updates.groupBy(*keys).agg(last).select(*keys, "_last.*")


@contextmanager
def session_settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    """Session settings for the start of a query, which copies them, put back afterwards."""
    before = {name: spark.conf.get(name, None) for name in values}
    try:
        for name, value in values.items():
            spark.conf.set(name, value)
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def settings(spark: SparkSession, **values: str):
    """Settings of Structured Streaming."""
    return session_settings(spark, {f"spark.sql.streaming.{name}": value for name, value in values.items()})


def single_operator(spark: SparkSession):
    """For streams with one stateful operator: a row behind the watermark is always dropped.

    By default lateness is judged by the watermark one batch earlier.
    """
    return settings(spark, **{"statefulOperator.allowMultiple": "false"})


def merge_sessions_early(spark: SparkSession):
    """Session windows: rows of a task are merged into sessions before the shuffle."""
    return settings(spark, **{"sessionWindow.merge.sessions.in.local.partition": "true"})
