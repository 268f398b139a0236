"""Connected components by alternating large-star and small-star steps (public work: Kiveris et al., 2014).

Each step is a group minimum and a join, so a node with very many neighbours
costs a split join, not one large task. The minima are written tables: only then
can Spark deal a skewed side of the join anew.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from timeloom.llm.runtime import Scratch

#: Edges that are worth a task of their own.
TASK_EDGES = 100_000


def _settled(edges: DataFrame) -> bool:
    """Are all edges stars: one lower end for each upper end, and that no upper end itself?"""
    twice = edges.groupBy("hi").agg(F.count("*").alias("n")).filter("n > 1").select("hi")
    inner = edges.select("hi").join(edges.select(F.col("lo").alias("hi")), "hi", "left_semi")
    return not twice.unionByName(inner).limit(1).count()


def connected_components(edges: DataFrame, scratch: Scratch, label: str = "cc") -> DataFrame:
    """(node, component) for each node of edges (a, b) that isn't its component's smallest; a written table."""
    now = edges.select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo")).filter("lo < hi").distinct()
    now = scratch.save(now, f"{label}-0")
    tasks, step = 1 + now.count() // TASK_EDGES, 0  # no step makes more edges than there are
    while not _settled(now):
        step += 1
        both = now.select(F.col("lo").alias("u"), F.col("hi").alias("v")).unionByName(now.select(F.col("hi").alias("u"), F.col("lo").alias("v")))
        least = scratch.save(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")).coalesce(tasks), f"{label}-l{step}")
        large = now.select(F.col("lo").alias("u"), F.col("hi").alias("v")).join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = scratch.save(large.distinct().coalesce(tasks), f"{label}-m{step}")
        least2 = scratch.save(large.groupBy("u").agg(F.min("v").alias("m")).coalesce(tasks), f"{label}-n{step}")
        small = large.join(least2, "u").filter("v != m").select(F.col("v").alias("hi"), F.col("m").alias("lo"))
        small = small.unionByName(least2.select(F.col("u").alias("hi"), F.col("m").alias("lo"))).distinct()
        now = scratch.save(small.coalesce(tasks), f"{label}-{step}")
        scratch.drop(*[f"{label}-{name}{step}" for name in "lmn"], f"{label}-{step - 1}")
    return now.select(F.col("hi").alias("node"), F.col("lo").alias("component"))
