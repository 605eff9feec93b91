"""Collectives over a ``(job, rank, vec)`` table: every job is a group of ``world`` ranks.

The group is bounded by the world size, not by the data, so per-job aggregates are small; the per-(job, pos)
sums run as ordinary partial + final aggregates. Nothing is sent through the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablegrad.operators.layout import checked


def _cells(df: DataFrame) -> DataFrame:
    return df.select("job", "rank", F.posexplode("vec").alias("pos", "x"))


def broadcast_from(df: DataFrame, root: int = 0) -> DataFrame:
    """Every rank receives the root's vector (equi-join on job)."""
    src = df.where(F.col("rank") == root).select("job", F.col("vec").alias("_root"))
    j = df.select("job", "rank").join(src, "job", "left")
    return j.select("job", "rank", checked(F.col("_root"), F.col("_root").isNotNull(), "broadcast: a job has no root").alias("vec"))


def all_reduce(df: DataFrame) -> DataFrame:
    """Every rank receives the elementwise sum over its job -> cells (job, rank, pos, x)."""
    s = _cells(df).groupBy("job", "pos").agg(F.sum("x").alias("x"))
    return df.select("job", "rank").join(s, "job")


def gather(df: DataFrame, root: int = 0, width: int = 1) -> DataFrame:
    """The root receives the concatenation by rank -> cells (job, rank=root, pos = src_rank*width + i, x).

    Other ranks receive an empty vector, i.e. no cells. ``width`` is the per-rank vector length.
    """
    c = _cells(df.withColumn("vec", checked(F.col("vec"), F.size("vec") == width, "gather: ranks of unequal width")))
    return c.select("job", F.lit(root).cast("int").alias("rank"),
                    (F.col("rank") * F.lit(width) + F.col("pos")).cast("int").alias("pos"), "x")


def reduce_scatter(df: DataFrame, world: int, width: int) -> DataFrame:
    """Rank r receives slice r of the elementwise sum (slice length width / world)."""
    if width % world:
        raise ValueError("reduce_scatter: width must divide by the world size")
    chunk = width // world
    s = _cells(df).groupBy("job", "pos").agg(F.sum("x").alias("x"))
    return s.select("job", (F.col("pos") / chunk).cast("int").alias("rank"),
                    (F.col("pos") % chunk).cast("int").alias("pos"), "x")
