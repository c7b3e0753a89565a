"""Intermediate tables in the cluster's shared folder, and splits of a table by a list of keys."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rillrank.session import run_dir

#: A list of keys is broadcast up to this many rows of 8 bytes; beyond it the table is shuffled.
BROADCAST_KEYS = 2_000_000


def saved(df: DataFrame, name: str) -> DataFrame:
    """Writes a table to the shared folder and reads it back: later steps do not depend on its executors."""
    path = run_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def fresh(columns: list[str], *names: str) -> list[str]:
    """The names with as many underscores in front as make them clash with no column, in any case."""
    taken = {c.lower() for c in columns}
    out = []
    for name in names:
        name = f"_{name}"
        while name.lower() in taken:
            name = f"_{name}"
        out.append(name)
    return out


def flagged(df: DataFrame, keys: DataFrame, key: str, flag: str, bound: int = BROADCAST_KEYS) -> DataFrame:
    """`df` with a BOOLEAN `flag`: whether its `key` is among `keys` (one column `key`, no repeats).

    The keys are counted first. Up to `bound` they are broadcast and `df` stays where it is.
    """
    same, there = fresh([*df.columns, flag], "key", "in")
    named = keys.select(F.col(key).alias(same), F.lit(True).alias(there))
    if keys.count() <= bound:
        named = F.broadcast(named)
    joined = df.join(named, F.col(key) == F.col(same), "left")
    return joined.withColumn(flag, F.col(there).isNotNull()).drop(same, there)
