"""Tensors derived from the given tables, and the fixed formula parameters shared with the SQL oracles."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablegrad.functions.columns import as_double_array

EMB_DIM = 64
N_CLASSES = 10


def table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d.rstrip('/')}/{name}.parquet")


def emb_rows(spark: SparkSession, d: str) -> DataFrame:
    """embeddings -> R layout ``(row_id, vec ARRAY<DOUBLE>, label)``; float widened to double first."""
    return table(spark, d, "embeddings").select(F.col("vec_id").alias("row_id"),
                                                 as_double_array("embedding").alias("vec"), "label")


def li_rows(spark: SparkSession, d: str) -> DataFrame:
    """lineitem -> 4 scaled features per row (all in [0, ~1]).

    (l_orderkey, l_linenumber) is not unique, so results keep both keys and duplicate rows stay interchangeable.
    """
    li = table(spark, d, "lineitem")
    return li.select("l_orderkey", "l_linenumber", li_vec().alias("vec"))


def li_vec():
    return F.array(F.col("l_quantity") / F.lit(50.0), F.col("l_extendedprice") / F.lit(100000.0),
                   F.col("l_discount") * F.lit(10.0), F.col("l_tax") * F.lit(10.0))


def li_regression(spark: SparkSession, d: str) -> DataFrame:
    """lineitem as a regression set: 3 scaled features -> scaled price."""
    li = table(spark, d, "lineitem")
    return li.select(F.array(F.col("l_quantity") / F.lit(50.0), F.col("l_discount") * F.lit(10.0),
                             F.col("l_tax") * F.lit(10.0)).alias("features"),
                     F.array(F.col("l_extendedprice") / F.lit(100000.0)).alias("target"))


# Fixed formula parameters (identical expressions appear in the SQL oracles).
def formula_w(k: int, n: int, salt: int = 0) -> np.ndarray:
    """w[k, j] = ((k*37 + j*17 + salt) % 101 - 50) / 500"""
    kk, jj = np.meshgrid(np.arange(k), np.arange(n), indexing="ij")
    return (((kk * 37 + jj * 17 + salt) % 101) - 50) / 500.0


def formula_b(n: int) -> np.ndarray:
    """b[j] = ((j*13) % 7 - 3) / 10"""
    j = np.arange(n)
    return (((j * 13) % 7) - 3) / 10.0


ROW_VEC_4 = np.array([0.25, 0.5, 0.75, 1.0])  # (j + 1) / 4: the broadcast row vector used on lineitem
