"""The given tables as the record types of the jobs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def number_of_props(props: str = "props"):
    return F.from_json(F.col(props), "k INT")["k"]


def as_traffic(events: DataFrame) -> DataFrame:
    """Users as hosts; packets from the number in ``props``, bytes from ``value``."""
    k = number_of_props()
    return events.select(
        "event_id", F.col("ts").alias("event_time"), F.col("user_id").cast("string").alias("client_ip"),
        k.alias("k"), "value",
    ).select(
        "event_id", "event_time", "client_ip",
        F.col("k").cast("bigint").alias("c2s_pkt_num"),
        (F.col("k") % 7).cast("bigint").alias("s2c_pkt_num"),
        F.floor(F.col("value") * 100).cast("bigint").alias("c2s_byte_num"),
        F.floor(F.col("value") * 10).cast("bigint").alias("s2c_byte_num"),
    )


def as_lines(events: DataFrame) -> DataFrame:
    """``event_type,number`` text lines."""
    line = F.concat(F.col("event_type"), F.lit(","), (F.col("user_id") % 20).cast("string"))
    return events.select(F.col("event_id").alias("seq"), F.col("ts").alias("arrival_ts"), line.alias("value"))


def as_value_lines(events: DataFrame) -> DataFrame:
    """``user,value`` text lines with a whole-number value."""
    line = F.concat_ws(",", F.col("user_id").cast("string"), F.floor("value").cast("string"))
    return events.select(F.col("event_id").alias("seq"), line.alias("value"))


def as_pairs(events: DataFrame) -> DataFrame:
    return events.select(F.col("event_id").alias("seq"), F.col("user_id").alias("key"), "value")


def as_numbers(events: DataFrame) -> DataFrame:
    return events.select(
        F.col("event_id").alias("seq"), F.col("ts").alias("arrival_ts"), "user_id", "event_type",
        number_of_props().cast("bigint").alias("k"),
    )
