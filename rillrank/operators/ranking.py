"""Top-N per window, as rows, as nested lists and as text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rillrank import fixed
from rillrank.operators.windows import end_millis

# Up to this N, Spark cuts each task's rows to N per group before the shuffle.
_GROUP_LIMIT = 1000
_MIN_PARTS = 64

# What hosts are ranked by: the sum of these columns.
ORDERS: dict[str, list[str]] = {
    "session_num": ["session_num"],
    "bytes": ["c2s_byte_num", "s2c_byte_num"],
    "packets": ["c2s_pkt_num", "s2c_pkt_num"],
}

HOST_COLUMNS = [
    "rank", "client_ip", "session_num", "order_by",
    "c2s_pkt_num", "s2c_pkt_num", "c2s_byte_num", "s2c_byte_num", "window_end_ms",
]


def top_n(df: DataFrame, groups: list[str], by: Column, tie: str, n: int, out: str = "rank") -> DataFrame:
    """The ``n`` rows of each group with the largest ``by``, ranked from 1; ties by ``tie``.

    The condition is on the 1-based number because that form is pushed below the shuffle.
    Beyond the N for which Spark does so, a first cut per part of a group keeps a large
    group from reaching one task whole.
    """
    best_first = [by.desc_nulls_last(), F.col(tie).asc()]
    if n > _GROUP_LIMIT:
        tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        part = F.pmod(F.xxhash64(tie), F.lit(max(_MIN_PARTS, tasks)))
        parts = Window.partitionBy(*groups, "_part").orderBy(*best_first)
        df = (
            df.withColumn("_part", part).withColumn(out, F.row_number().over(parts))
            .filter(F.col(out) <= n).drop("_part", out)
        )
    whole = Window.partitionBy(*groups).orderBy(*best_first)
    return df.withColumn(out, F.row_number().over(whole)).filter(F.col(out) <= n)


def top_hosts_of_windows(aggregated: DataFrame, order_by: str = "session_num", n: int = fixed.TOP_N) -> DataFrame:
    """Ranked hosts of each window from one row per (window, host)."""
    ranked = top_n(aggregated, ["window_end"], F.expr(" + ".join(ORDERS[order_by])), "client_ip", n)
    return ranked.withColumns(
        {"order_by": F.lit(order_by), "window_end_ms": end_millis(F.col("window_end"))}
    ).select(*HOST_COLUMNS)


def nest_hosts(ranked: DataFrame) -> DataFrame:
    """One row per window with its list of at most N ranked records."""
    record = F.struct(*[c for c in HOST_COLUMNS if c != "window_end_ms"])
    return ranked.groupBy("window_end_ms").agg(F.sort_array(F.collect_list(record)).alias("hosts"))


def flatten_hosts(nested: DataFrame) -> DataFrame:
    return nested.select("window_end_ms", F.inline("hosts")).select(*HOST_COLUMNS)


def render_report(ranked: DataFrame, with_time: bool = False) -> DataFrame:
    """One text per window: a rule, a line per rank from 0, a rule and a blank line."""
    line = F.format_string(
        fixed.REPORT_LINE,
        (F.col("rank") - 1).cast("string"), F.col("client_ip"),
        *[F.col(c).cast("string") for c in HOST_COLUMNS[2:3] + HOST_COLUMNS[4:]],
        F.col("order_by"),
    )
    lines = F.sort_array(F.collect_list(F.struct("rank", line.alias("line"))))
    head = F.lit(fixed.REPORT_RULE + "\n")
    if with_time:
        stamp = F.date_format(F.timestamp_millis("window_end_ms"), "yyyy-MM-dd HH:mm:ss.S")
        head = F.concat(head, F.lit(fixed.REPORT_TIME), stamp, F.lit("\n"))
    body = F.array_join(F.transform("lines", lambda r: F.concat(r["line"], F.lit("\n"))), "")
    report = F.concat(head, body, F.lit(fixed.REPORT_RULE + "\n\n"))
    return ranked.groupBy("window_end_ms").agg(lines.alias("lines")).select("window_end_ms", report.alias("report"))
