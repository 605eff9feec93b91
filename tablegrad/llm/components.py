"""Connected components by repeated contraction, on tables alone.

Every node takes the smallest id among itself and its neighbours as its label, and the edges between labels form the
next, smaller graph. Labels are minima that Spark sums up in part before it shuffles, so a hub with very many
neighbours is no problem; each round is written to the shared folder, nothing is collected but counts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import checkpointed


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node of ``edges`` (a, b); the component is its smallest node."""
    e = checkpointed(edges.select("a", "b").where("a <> b").distinct())
    levels = []
    while not e.isEmpty():
        both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        label = checkpointed(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("a"), F.min("b")).alias("label")))
        levels.append(label)
        la = label.select(F.col("node").alias("a"), F.col("label").alias("x"))
        lb = label.select(F.col("node").alias("b"), F.col("label").alias("y"))
        up = e.join(la, "a").join(lb, "b").where("x <> y")
        e = checkpointed(up.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct())
    if not levels:
        return e.select(F.col("a").alias("node"), F.col("b").alias("component"))
    out = levels[0].select("node", F.col("label").alias("component"))
    for label in levels[1:]:
        up = label.select(F.col("node").alias("component"), "label")
        out = out.join(up, "component", "left").select("node", F.coalesce("label", "component").alias("component"))
    return checkpointed(out) if len(levels) > 1 else out
