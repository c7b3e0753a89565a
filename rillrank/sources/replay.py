"""A stored table replayed as a stream in several steps, in the order of a column.

A table's files have no order in time: handed out by name or age, rows of a later trigger can lie behind
the watermark or before rows that were already used. Here each step of a replay is a set of files, and no
file of a later step begins before an earlier one ends. A query runs once per step over one checkpoint, so
its watermark and state go on from step to step, and a replay that failed goes on where it stopped.

The steps come from the smallest and largest value of the order column in each file: one row per file,
which is what a listing of the table holds as well. Files whose ranges overlap share a step. A table whose
files overlap too much for the wanted number of steps is written once more, cut by ranges of the column.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterable
from dataclasses import dataclass
from typing import Any

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from rillrank.session import run_dir

#: The source forgets files older than this against the newest one seen; here age means nothing.
_ANY_AGE = "36500d"
STEP = "_step"
_PATTERN = re.compile(r"[{}\[\]*?,\\]")


@dataclass(frozen=True)
class FileRange:
    """A file and its smallest and largest value; both None if it has no value."""

    path: str
    first: Any
    last: Any


@dataclass(frozen=True)
class Step:
    """The files of one step, all of them in or below `folder`; all files of the folder if none are named."""

    folder: str
    files: tuple[str, ...] = ()

    @property
    def pattern(self) -> str:
        if not self.files:
            return f"{self.folder}/*.parquet"
        names = ",".join(f.removeprefix(f"{self.folder}/") for f in self.files)
        return f"{self.folder}/{{{names}}}"


@dataclass(frozen=True)
class Replay:
    """Steps over a table of a schema."""

    schema: T.StructType
    steps: tuple[Step, ...]

    def stream(self, spark: SparkSession, step: int) -> DataFrame:
        """The rows of one step. The query that reads them must keep its checkpoint for all steps."""
        return (spark.readStream.schema(self.schema).option("maxFileAge", _ANY_AGE)
                .parquet(self.steps[step].pattern))


def file_ranges(spark: SparkSession, path: str, order: str) -> list[FileRange]:
    """One row per file, from a scan of the order column alone."""
    rows = (
        spark.read.parquet(path).groupBy(F.col("_metadata.file_path").alias("path"))
        .agg(F.min(order).alias("first"), F.max(order).alias("last"))
    )
    # Paths are URIs here; patterns take them as they are named.
    unquoted = rows.withColumn("path", F.url_decode(F.replace("path", F.lit("+"), F.lit("%2B"))))
    return [FileRange(*r) for r in unquoted.collect()]


def plan_steps(ranges: Iterable[FileRange], wanted: int) -> list[list[FileRange]]:
    """At most `wanted` steps, as even in files as the ranges allow.

    A step may end only where every later file begins after all before it have ended, so no row of a later
    step lies before a row of an earlier one, with any watermark delay. Files without a value come first.
    """
    known = sorted((r for r in ranges if r.first is not None), key=lambda r: (r.first, r.last, r.path))
    empty = [r for r in ranges if r.first is None]
    # Runs of files that overlap.
    runs: list[list[FileRange]] = []
    until = None
    for r in known:
        if runs and r.first <= until:
            runs[-1].append(r)
            until = max(until, r.last)
        else:
            runs.append([r])
            until = r.last
    size = -(-len(known) // wanted)
    steps: list[list[FileRange]] = []
    for run in runs:
        if steps and len(steps[-1]) < size:
            steps[-1] += run
        else:
            steps.append(run)
    if empty:
        steps[:1] = [empty + (steps[0] if steps else [])]
    return steps


def ordered_copy(spark: SparkSession, path: str, order: str, steps: int) -> Replay:
    """Writes the table in `steps` folders, each holding a range of the order column. Rows without a value are
    in the first. Rows of one value always share a folder, so very frequent values make steps uneven or fewer."""
    rows = spark.read.parquet(path)
    place = _number(rows, order)
    found = rows.select(F.percentile_approx(place, [i / steps for i in range(1, steps)], 10_000).alias("cuts")).first()["cuts"]
    step = F.lit(0)
    for i, cut in enumerate(sorted(set(found or [])), 1):
        step = F.when(place > cut, i).otherwise(step)
    return copy_by_step(rows, step)


def copy_by_step(rows: DataFrame, step: Column) -> Replay:
    """Writes a table in a folder per value of `step`, an integer that says in which step a row arrives."""
    spark = rows.sparkSession
    base = run_dir(spark, "replay")
    # Rows stay in the tasks that read them: no shuffle, at most one file per task and step.
    rows.withColumn(STEP, step).write.partitionBy(STEP).parquet(base)
    files = spark.read.schema(T.StructType([*rows.schema.fields, T.StructField(STEP, T.IntegerType())])).parquet(base)
    present = files.select(STEP).distinct().orderBy(STEP).collect()
    return Replay(rows.schema, tuple(Step(f"{base}/{STEP}={r[0]}") for r in present) or (Step(base),))


def _number(rows: DataFrame, order: str) -> Column:
    """The order column as a number; times as the instants that a stream of them uses."""
    if isinstance(rows.schema[order].dataType, (T.TimestampType, T.TimestampNTZType)):
        return F.unix_micros(F.col(order).cast("timestamp"))
    return F.col(order)


def replay_of(spark: SparkSession, path: str, order: str, steps: int) -> Replay:
    """A replay of a table in about `steps` steps: over its own files if they allow it, else over a copy. Files
    whose names mean something in a pattern do not."""
    ranges = file_ranges(spark, path, order)
    planned = plan_steps(ranges, steps)
    odd = any(_PATTERN.search(r.path.rpartition("/")[2]) for r in ranges)
    if odd or len(planned) < steps and any(r.first != r.last for r in ranges):
        return ordered_copy(spark, path, order, steps)
    folder = path.rstrip("/")
    # The scan names files by URI; patterns keep the scheme that the table was given with.
    plain = folder.partition("://")[2] or folder
    named = [sorted(f"{folder}{r.path.partition(plain)[2]}" for r in step) for step in planned]
    if any(folder in files for files in named):  # the table is one file
        folder = folder.rpartition("/")[0]
    steps_of = tuple(Step(folder, tuple(files)) for files in named) or (Step(folder),)
    return Replay(spark.read.parquet(path).schema, steps_of)


def remembered(spark: SparkSession, manifest: str, make: Callable[[], Replay]) -> Replay:
    """The replay whose steps are listed in the table `manifest`; made, and listed there, if it is not there yet.
    A query that is started again so meets the files its checkpoint knows."""
    try:
        listed = spark.read.parquet(manifest).orderBy("step").collect()
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        replay = make()
        rows = [(i, s.folder, list(s.files), replay.schema.json()) for i, s in enumerate(replay.steps)]
        spark.createDataFrame(rows, "step INT, folder STRING, files ARRAY<STRING>, schema STRING").coalesce(1) \
            .write.parquet(manifest)
        return replay
    schema = T.StructType.fromJson(json.loads(listed[0]["schema"])) if listed else T.StructType()
    return Replay(schema, tuple(Step(r["folder"], tuple(r["files"])) for r in listed))


def run(replay: Replay, spark: SparkSession, start: Callable[[DataFrame], StreamingQuery]) -> list[list[dict]]:
    """Runs a query over all steps and gives the progress reports of each.

    `start` must start the same query each time, over one checkpoint, and stop when all is read (``every=None``).
    Steps that an earlier run finished are passed over by the checkpoint: their files are known there.
    """
    reports = []
    for i in range(len(replay.steps)):
        query = start(replay.stream(spark, i))
        query.awaitTermination()
        reports.append(list(query.recentProgress))
    return reports
