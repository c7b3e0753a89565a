"""JSON lines to typed rows, with bad lines routed aside."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rillrank import schemas


@dataclass(frozen=True)
class Parsed:
    rows: DataFrame
    rejects: DataFrame


_FIELD = "_json_"


def _parse(df: DataFrame, schema: T.StructType, text: str) -> DataFrame:
    """The fields beside ``df``, as ``_json_*`` columns.

    They come out of a generator: conditions on them stay above it, so a line is parsed
    once. Conditions on a projected record would be pushed below it and parse again.
    """
    record = F.from_json(
        F.col(text), schemas.with_corrupt(schema),
        {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": schemas.CORRUPT},
    )
    names = [_FIELD + f.name for f in schema.fields] + [_FIELD + schemas.CORRUPT]
    return df.select("*", F.inline(F.array(record)).alias(*names))


def _is_bad(text: str) -> Column:
    # Blank text parses to a record of NULLs without a corrupt mark.
    return F.col(_FIELD + schemas.CORRUPT).isNotNull() | F.col(text).isNull() | (F.trim(F.col(text)) == "")


def parse_json(df: DataFrame, schema: T.StructType, text: str = "value", mode: str = "permissive") -> Parsed:
    """Fields of ``schema`` beside the other columns of ``df``.

    ``permissive`` moves unreadable lines to ``rejects``; ``failfast`` stops the job
    at the first one.
    """
    if mode not in ("permissive", "failfast"):
        raise ValueError(f"unknown mode: {mode}")
    parsed = _parse(df, schema, text)
    bad = _is_bad(text)
    if mode == "failfast":
        stop = F.raise_error(F.concat(F.lit("unreadable line: "), F.coalesce(text, F.lit("NULL"))))
        good, rejects = F.when(bad, stop.cast("boolean")).otherwise(True), df.filter(F.lit(False))
    else:
        good, rejects = ~bad, parsed.filter(bad).select(*df.columns)
    fields = [F.col(_FIELD + f.name).alias(f.name) for f in schema.fields]
    return Parsed(parsed.filter(good).select(*[c for c in df.columns if c != text], *fields), rejects)


def parse_traffic(df: DataFrame, text: str = "value", mode: str = "permissive") -> Parsed:
    """Traffic records: absent numbers are 0, and so is an absent ``recv_time`` (1970, hence late)."""
    parsed = parse_json(df, schemas.TRAFFIC_JSON, text, mode)
    numbers = {
        name: F.coalesce(F.col(name), F.lit(0)) for name in [*schemas.TRAFFIC_NUMBERS, "recv_time"]
    }
    return Parsed(parsed.rows.withColumns(numbers), parsed.rejects)


def parse_students(df: DataFrame, text: str = "value", mode: str = "permissive") -> Parsed:
    parsed = parse_json(df, schemas.STUDENT, text, mode)
    return Parsed(parsed.rows.withColumn("age", F.coalesce("age", F.lit(0))), parsed.rejects)


def with_event_time(traffic: DataFrame, out: str = "event_time") -> DataFrame:
    """The traffic tuple with ``recv_time`` (epoch milliseconds) as a timestamp."""
    return traffic.withColumn(out, F.timestamp_millis(F.col("recv_time")))


def rename_traffic(traffic: DataFrame) -> DataFrame:
    """Record names of the in-memory form: ``source`` and ``__time``."""
    return traffic.withColumnsRenamed({"client_ip": "source", "recv_time": "__time"})


def drop_keyless(df: DataFrame, key: str = "client_ip", observe: str | None = None) -> DataFrame:
    """Drops rows without a key; counts them under the observation ``observe`` if named.

    Observing keeps the filter above the scan, so batch queries leave it off.
    """
    if observe:
        df = df.observe(observe, F.count(F.when(F.col(key).isNull(), 1)).alias("dropped"))
    return df.filter(F.col(key).isNotNull())
