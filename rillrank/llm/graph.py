"""Connected components of a distributed edge list."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rillrank.llm.tables import saved


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) for each node that has an edge to another: root is the smallest node it can reach.

    Alternates two steps until nothing changes, which takes few rounds (logarithmic in the longest
    chain): every node hands the smallest node it sees to its larger neighbours, then to the smaller
    ones. Each step is written to the shared folder, so that both sides of a join are plain tables and
    Spark can cut up a node with very many edges. No list of neighbours is ever gathered.
    """
    now = saved(edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
                .where(F.col("u") != F.col("v")).distinct(), "edges")
    mark = _mark(now)
    while mark[0]:
        both = now.union(now.select("v", "u"))
        least = saved(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "least")
        large = saved(both.join(least, "u").where(F.col("v") > F.col("u")).select(F.col("v").alias("u"),
                                                                                  F.col("m").alias("v"))
                      .where(F.col("u") != F.col("v")).distinct(), "edges")
        least = saved(large.groupBy("u").agg(F.min("v").alias("m")), "least")
        small = large.join(least, "u").where(F.col("v") != F.col("m")).select(F.col("v").alias("u"),
                                                                              F.col("m").alias("v"))
        now = saved(small.union(least.select("u", F.col("m").alias("v"))).distinct(), "edges")
        before, mark = mark, _mark(now)
        if mark == before:
            break
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
        now.select("v", "v").distinct())


def _mark(edges: DataFrame) -> tuple:
    """A checksum that tells two edge lists apart."""
    row = edges.agg(F.count("*").alias("n"), F.sum(F.shiftright(F.xxhash64("u", "v"), 24)).alias("s"),
                    F.bit_xor(F.xxhash64("u", "v")).alias("x")).first()
    return row["n"], row["s"], row["x"]
