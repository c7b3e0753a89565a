"""Threshold operators: the stateless breach flag and the alert every n-th breach."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rillrank import fixed
from rillrank.operators.ordered import Skew, consecutive_groups, values_in_order


def breach_flags(df: DataFrame, threshold: float = fixed.ALERT_THRESHOLD, value: str = "value",
                 message: str = fixed.BREACH_MESSAGE, keep: list[str] | None = None) -> DataFrame:
    """One message per row above the threshold (a row at the threshold gives none)."""
    return df.filter(F.col(value) > threshold).select(*(keep or []), F.lit(message).alias("message"))


def alert_message(key: str) -> Column:
    return F.concat(F.col(key).cast("string"), F.lit(fixed.ALERT_SUFFIX))


def threshold_alerts(df: DataFrame, threshold: float = fixed.ALERT_THRESHOLD, times: int = fixed.ALERT_TIMES,
                     key: str = "key", order: str = "seq", value: str = "value",
                     skew: Skew = Skew()) -> DataFrame:
    """An alert for every ``times`` breaches of a key (at or above the threshold), in row order.

    ``alert_no`` counts from 1 per key. Only breaches are shuffled, and a list holds
    ``times`` values, never a whole key.
    """
    if times < 1:
        raise ValueError("times must be at least 1")
    breaches = df.filter(F.col(value) >= threshold).select(key, order, value)
    alert_no = F.col("_group") + 1
    return full_groups(breaches, times, key, order, value, skew).select(
        key, alert_no.alias("alert_no"), "last_seq", alert_message(key).alias("message"), "abnormal_values"
    )


def full_groups(breaches: DataFrame, times: int, key: str, order: str, value: str, skew: Skew) -> DataFrame:
    return (
        consecutive_groups(breaches, [key], order, times, skew).groupBy(key, "_group")
        .agg(F.max(order).alias("last_seq"), values_in_order(value).alias("abnormal_values"))
        .filter(F.size("abnormal_values") == times)
    )
