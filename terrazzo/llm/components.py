"""Connected components by alternating large-star and small-star steps over an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrazzo.llm.common import drop, stash


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(edges: DataFrame) -> DataFrame:
    """id, component (the smallest id reachable) of every id in the columns u, v of edges; rounds grow with the logarithm of
    a component's size, and each is written to the shared folder. Only counts come to the driver."""
    now = stash(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v").distinct(), "edges")
    state = _state(now)
    while state[0]:
        # each row is read as few times as it can be: a round's plan is short, and so is what the driver holds of it
        least = ends(now).groupBy("id").agg(F.min("v").alias("m")).select("id", F.least("id", "m").alias("m"))
        large = now.join(least, F.col("v") == F.col("id")).select("u", F.col("m").alias("v"))
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct("u", F.col("m").alias("v")))).alias("e")).select("e.*")
        now, old = stash(small.where("u <> v").distinct(), "edges"), now
        drop(old)
        before, state = state, _state(now)
        if state == before:
            break
    return now.select(F.explode(F.array(F.struct(F.col("u").alias("id"), "v"), F.struct(F.col("v").alias("id"), "v"))).alias("e")).groupBy("e.id").agg(F.min("e.v").alias("component"))


def ends(edges: DataFrame) -> DataFrame:
    """id, v: each edge from both of its ends."""
    return edges.select(F.explode(F.array(F.struct(F.col("u").alias("id"), "v"), F.struct(F.col("v").alias("id"), F.col("u").alias("v")))).alias("e")).select("e.*")
