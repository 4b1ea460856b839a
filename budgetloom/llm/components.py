"""Connected components of an edge table, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from budgetloom.llm.common import stored
from budgetloom.operators.lookup import attach

EDGES_PER_FILE = 500_000


def _stars(edges: DataFrame, large: bool) -> DataFrame:
    """Large: each node's larger neighbours go to its least neighbour (itself included). Small: its smaller ones and itself do."""
    if large:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    else:
        both = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m")).withColumnRenamed("a", "n")
    joined = attach(both, least, {"n": F.col("a")}, how="inner")
    if large:
        out = joined.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        out = joined.where("b != m").select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(least.select(F.col("n").alias("a"), F.col("m").alias("b")))
    return out.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()


def components(edges: DataFrame, rounds: int = 60, tasks: int | None = None) -> DataFrame:
    """node, component (its least node) for the nodes of ``edges`` (columns a, b, both long; null or equal ends are no edges).

    Each round's edges are written; the number of rounds grows with the logarithm of the nodes. ``tasks``: how many write
    the first edges at most; a round writes a file for each ``EDGES_PER_FILE`` of those before it.
    """
    now = stored(edges.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges", tasks)
    files, before = 1 + now.count() // EDGES_PER_FILE, None
    for _ in range(rounds):
        now = stored(_stars(_stars(now, True), False), "edges", files)
        sign = tuple(now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        files = 1 + sign[0] // EDGES_PER_FILE
        if sign == before or not sign[0]:
            break
        before = sign
    else:
        raise RuntimeError("components did not settle")
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
