"""Reductions: full sum / mean, axis means, L2 norm, counts.

Row-wise reductions (axis = last) are array expressions with no shuffle. Column reductions (axis 0) are
``posexplode`` + ``groupBy(j)``: the partial aggregate runs map-side, so each task ships at most ``n`` rows per
partition no matter how many rows it read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablegrad.functions.columns import arr_mean, arr_sum, col


def sum_all(rows: DataFrame, vec_col: str = "vec", out: str = "total") -> DataFrame:
    """Scalar sum of every element; empty input gives 0.0."""
    return rows.agg(F.coalesce(F.sum(arr_sum(vec_col)), F.lit(0.0)).alias(out))


def mean_all(rows: DataFrame, vec_col: str = "vec", out: str = "mean") -> DataFrame:
    """Mean of every element; empty input gives NaN."""
    s = rows.agg(F.sum(arr_sum(vec_col)).alias("_s"), F.sum(F.size(vec_col)).alias("_n"))
    return s.select(F.when(F.coalesce(F.col("_n"), F.lit(0)) == 0, F.lit(float("nan")))
                    .otherwise(F.col("_s") / F.col("_n")).alias(out))


def column_stats(rows: DataFrame, vec_col: str = "vec", group_cols=()) -> DataFrame:
    """Per-column (j) sum, sum of squares and count, optionally per group. Map-side partial aggregation."""
    ex = rows.select(*group_cols, F.posexplode(col(vec_col)).alias("j", "x"))
    return ex.groupBy(*group_cols, "j").agg(F.sum("x").alias("s"), F.sum(F.col("x") * F.col("x")).alias("ss"),
                                           F.count("*").alias("n"))


def mean_axis0(rows: DataFrame, vec_col: str = "vec", out: str = "mean") -> DataFrame:
    """``[m, n] -> [n]``: column means as cells (j, mean)."""
    ex = rows.select(F.posexplode(col(vec_col)).alias("j", "x"))
    return ex.groupBy("j").agg(F.avg("x").alias(out))


def sum_axis0(rows: DataFrame, vec_col: str = "vec", out: str = "total") -> DataFrame:
    ex = rows.select(F.posexplode(col(vec_col)).alias("j", "x"))
    return ex.groupBy("j").agg(F.sum("x").alias(out))


def mean_axis1(a) -> "F.Column":
    """``[m, n] -> [m]``: per-row mean, an expression (no shuffle)."""
    return arr_mean(a)


def l2_norm(rows: DataFrame, vec_col: str = "vec", out: str = "l2") -> DataFrame:
    return rows.agg(F.sqrt(F.coalesce(F.sum(arr_sum(F.transform(col(vec_col), lambda x: x * x))),
                                      F.lit(0.0))).alias(out))


def l2_norm_by(rows: DataFrame, key_cols, v: str = "v", out: str = "l2") -> DataFrame:
    """Per-group L2 norm over cell values."""
    return rows.groupBy(*key_cols).agg(F.sqrt(F.sum(F.col(v) * F.col(v))).alias(out))
