"""Elementwise arithmetic over tensors in row layout (array columns) or cell layout.

Same-shape operands in one row are zipped (no shuffle). Broadcasting:

* row broadcast ``[m, n] op [n]`` -- the vector is as wide as a row, held as a literal array; every task applies it
  map-side, and another width fails the job.
* column broadcast ``[m, n] op [m]`` -- the vector is as long as the table, so it is an equi-join on the row id.
* scalar -- a literal or a one-value column.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablegrad.functions.columns import arr_binary, arr_scalar, arr_unary, col, lit_array
from tablegrad.operators.layout import checked

def ew_binary(a, b, op: str) -> Column:
    """Same-shape elementwise op of two array columns; size mismatch fails the job."""
    a, b = col(a), col(b)
    checked = F.when(F.assert_true(F.size(a) == F.size(b), F.lit(f"{op}: shapes differ")).isNull(), b)
    return arr_binary(op, a, checked)


def ew_scalar(a, s, op: str, scalar_left: bool = False) -> Column:
    """Array op scalar (or scalar op array for sub)."""
    if scalar_left and op == "sub":
        return arr_unary("neg", arr_scalar("sub", a, s))
    return arr_scalar(op, a, s)


def ew_unary(a, op: str, p: float | None = None) -> Column:
    return arr_unary(op, a, p)


def row_broadcast(a, vector: Sequence[float] | np.ndarray, op: str) -> Column:
    """``[m, n] op [n]``: combine every row with one bounded vector."""
    return ew_binary(a, lit_array(np.asarray(vector, dtype=np.float64).ravel()), op)


def col_broadcast(rows: DataFrame, colvec: DataFrame, op: str, id_col: str = "row_id", vec_col: str = "vec",
                  c_col: str = "c", out_col: str = "out") -> DataFrame:
    """``[m, n] op [m]``: per-row scalar from a second table, equi-joined on the row id."""
    j = rows.join(colvec.select(id_col, F.col(c_col).alias("_c"), F.lit(True).alias("_there")), id_col, "left")
    c = checked(F.col("_c"), F.col("_there"), f"{op}: the column vector has no entry for a row")
    return j.withColumn(out_col, arr_scalar(op, vec_col, c)).drop("_c", "_there")


def cells_binary(a: DataFrame, b: DataFrame, keys: Sequence[str], op: str, v: str = "v") -> DataFrame:
    """Elementwise op of two cell tables matched on their index keys (sort-merge or broadcast, by size)."""
    fn = {"add": lambda x, y: x + y, "sub": lambda x, y: x - y, "mul": lambda x, y: x * y}[op]
    j = a.select(*keys, F.col(v).alias("_a"), F.lit(True).alias("_l")).join(
        b.select(*keys, F.col(v).alias("_b"), F.lit(True).alias("_r")), list(keys), "full_outer")
    both = F.col("_l").isNotNull() & F.col("_r").isNotNull()
    return j.select(*keys, checked(fn(F.col("_a"), F.col("_b")), both, f"{op}: shapes differ").alias(v))


def fill_like(a, value: float) -> Column:
    """Same shape, constant value (zerosLike / fill)."""
    return F.transform(col(a), lambda x: F.lit(float(value)))


def int_to_tensor(a, expected_size: int | None = None) -> Column:
    """Widen an integer array to doubles, checking its size against the declared shape."""
    a = col(a)
    if expected_size is not None:
        a = F.when(F.assert_true(F.size(a) == expected_size,
                                 F.lit(f"int_to_tensor: size must be {expected_size}")).isNull(), a)
    return F.transform(a, lambda x: x.cast("double"))
