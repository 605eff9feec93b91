"""Backward rules as table plans: given the upstream gradient, produce the input gradients.

Row-layout tensors keep the upstream gradient ``g`` next to the forward values in the same row, so most rules
are per-row array expressions. Rules that contract over the sample axis (bias = column sum, weight = Xᵀ·G) are
aggregates with map-side partial sums.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablegrad.functions.columns import (arr_binary, arr_dot, arr_scalar, arr_sum, bind, col, lit_array,
                                         ln_ieee, relu_grad, vec_matmul)
from tablegrad.operators import linalg, reduce


# ---------------------------------------------------------------- elementwise rules
def grad_unary(op: str, x, g, p: float | None = None, y=None) -> Column:
    """d(op(x)) given upstream g: neg, pow/sqrt, reciprocal, log, relu, sigmoid (y = forward output)."""
    x, g = col(x), col(g)
    if op == "neg":
        return F.transform(g, lambda gi: -gi)
    if op in ("pow", "sqrt"):
        p = 0.5 if op == "sqrt" else float(p)
        return F.zip_with(x, g, lambda xi, gi: F.lit(p) * gi * F.pow(xi, F.lit(p - 1.0)))
    if op == "reciprocal":
        return F.zip_with(x, g, lambda xi, gi: -gi / (xi * xi))
    if op == "log":
        return F.zip_with(x, g, lambda xi, gi: gi / xi)
    if op == "relu":
        return F.zip_with(x, g, lambda xi, gi: gi * relu_grad(xi))
    if op == "sigmoid":
        yv = col(y) if y is not None else F.transform(x, lambda xi: F.lit(1.0) / (F.lit(1.0) + F.exp(-xi)))
        return F.zip_with(yv, g, lambda yi, gi: gi * yi * (F.lit(1.0) - yi))
    raise ValueError(op)


def grad_mul(a, b, g):
    """Same-shape product: (dA, dB) = (B*G, A*G)."""
    return arr_binary("mul", b, g), arr_binary("mul", a, g)


def grad_mul_scalar(rows: DataFrame, a: str, g: str, s: float):
    """``A * s`` with scalar s: dA = s*G per row; ds = sum(A*G) over every element."""
    da = arr_scalar("mul", g, s)
    ds = rows.agg(F.coalesce(F.sum(arr_dot(a, g)), F.lit(0.0)).alias("ds"))
    return da, ds


def grad_mul_row(rows: DataFrame, a: str, g: str, vector: np.ndarray):
    """``A * b`` with a row vector b: dA = b*G per row; db = column sums of A*G as cells (j, grad)."""
    da = arr_binary("mul", g, lit_array(np.asarray(vector, dtype=np.float64)))
    prod = rows.select(arr_binary("mul", a, g).alias("vec"))
    return da, reduce.sum_axis0(prod, out="grad")


def grad_softmax(y, g) -> Column:
    """Softmax backward along the last axis in O(n): y * (g - sum(g*y))."""
    def body(yv, gv):
        return F.aggregate(F.zip_with(yv, gv, lambda a, b: a * b), F.lit(0.0), lambda acc, v: acc + v,
                           lambda s: F.zip_with(yv, gv, lambda yi, gi: yi * (gi - s)))
    return bind(y, lambda yv: bind(g, lambda gv: body(yv, gv)))


def grad_softmax_cells(cells: DataFrame, slice_cols: Sequence[str], y: str = "y", g: str = "g",
                       out: str = "dx") -> DataFrame:
    """Softmax backward for any axis in cell layout: per-slice sum(g*y) aggregated and joined back."""
    s = cells.groupBy(*slice_cols).agg(F.sum(F.col(y) * F.col(g)).alias("_s"))
    return cells.join(s, list(slice_cols)).withColumn(out, F.col(y) * (F.col(g) - F.col("_s"))).drop("_s")


# ---------------------------------------------------------------- broadcast rules (add / sub)
def grad_add_broadcast(rows: DataFrame, g: str, case: str, id_col: str = "row_id", negate: bool = False):
    """Gradient reaching the smaller operand of an add (or sub when ``negate``):

    * ``'same'``   -> G itself (rows)
    * ``'row'``    -> column sums ``[n]``   (operand was a row vector)
    * ``'col'``    -> row sums ``[m]``      (operand was a column vector)
    * ``'scalar'`` -> total sum
    """
    sign = -1.0 if negate else 1.0
    if case == "same":
        return rows.select(id_col, arr_scalar("mul", g, sign).alias("grad"))
    if case == "row":
        return reduce.sum_axis0(rows.select(F.col(g).alias("vec")), out="grad").select(
            "j", (F.col("grad") * sign).alias("grad"))
    if case == "col":
        return rows.select(id_col, (arr_sum(g) * sign).alias("grad"))
    if case == "scalar":
        return rows.agg((F.coalesce(F.sum(arr_sum(g)), F.lit(0.0)) * sign).alias("grad"))
    raise ValueError(case)


# ---------------------------------------------------------------- reductions and layout rules
def grad_sum(g: float, a) -> Column:
    """d(sum(A)) = G broadcast to every cell (G is the scalar upstream)."""
    return F.transform(col(a), lambda x: F.lit(float(g)))


def grad_mean_all(g: float, a, n_total: int) -> Column:
    return F.transform(col(a), lambda x: F.lit(float(g) / n_total))


def grad_mean_axis0(a, g_vec: np.ndarray, m: int) -> Column:
    """mean over rows: dA[i, j] = G[j] / m."""
    return lit_array(np.asarray(g_vec, dtype=np.float64) / m) if a is None else F.transform(
        F.sequence(F.lit(0), F.size(col(a)) - 1), lambda j: F.element_at(lit_array(np.asarray(g_vec) / m), j + 1))


def grad_mean_axis1(a, g) -> Column:
    """mean over columns: dA[i, j] = G[i] / n (G is a per-row scalar column)."""
    a = col(a)
    return bind(g, lambda gv: F.transform(a, lambda x: gv / F.size(a)))


# ---------------------------------------------------------------- linear algebra rules
def grad_linear(rows: DataFrame, x: str, g: str, w: np.ndarray, bias: bool = True, method: str = "auto",
                mean: bool = False):
    """For ``Y = X·W (+ b)`` with upstream G in the same rows:
    dW = Xᵀ·G (cells k, j), db = column sums of G (cells j), dX = G·Wᵀ (per row).

    The bias gradient rides in the same aggregate as row k = in_features of ``[X, 1]ᵀ·G``, so the input is scanned
    once; ``mean=True`` averages over rows instead of summing (the 1/N of a mean loss without a counting pass).
    """
    w = np.asarray(w, dtype=np.float64)
    k = w.shape[0]
    if bias:
        aug = rows.select(F.concat(F.col(x), F.array(F.lit(1.0))).alias("_xa"), F.col(g).alias("_g"))
        both = linalg.outer_sum(aug, "_xa", "_g", method=method, width_a=k + 1, width_b=w.shape[1], mean=mean)
        dw = both.where(F.col("k") < k)
        db = both.where(F.col("k") == k).select("j", "v")
    else:
        dw = linalg.outer_sum(rows, x, g, method=method, width_a=k, width_b=w.shape[1], mean=mean)
        db = None
    dx = vec_matmul(g, w.T)
    return dw, db, dx


def linear_param_grads(rows: DataFrame, x: str, g: str, w: np.ndarray, weight_id: int = 0, bias_id: int = 1,
                       names=("0.weight", "0.bias"), method: str = "auto", mean: bool = False) -> DataFrame:
    """dW and db of a linear layer as one parameter-cell table ``(param_id, name, pos, grad)``.

    Both come out of a single ``[X, 1]ᵀ·G`` aggregate (one scan, one small shuffle); the bias is row k = in.
    """
    w = np.asarray(w, dtype=np.float64)
    k, n = w.shape
    aug = rows.select(F.concat(F.col(x), F.array(F.lit(1.0))).alias("_xa"), F.col(g).alias("_g"))
    both = linalg.outer_sum(aug, "_xa", "_g", method=method, width_a=k + 1, width_b=n, mean=mean)
    is_b = F.col("k") == k
    return both.select(F.when(is_b, F.lit(bias_id)).otherwise(F.lit(weight_id)).cast("int").alias("param_id"),
                       F.when(is_b, F.lit(names[1])).otherwise(F.lit(names[0])).alias("name"),
                       F.when(is_b, F.col("j")).otherwise(F.col("k") * n + F.col("j")).cast("int").alias("pos"),
                       F.col("v").alias("grad"))


def grad_matmul_cells(a: DataFrame, b: DataFrame, g: DataFrame):
    """General 2-D ``C = A·B`` in cells: dA = G·Bᵀ, dB = Aᵀ·G (two joins with swapped keys)."""
    da = linalg.cells_matmul(g, b, a_keys=("i", "j"), b_keys=("j", "k"), out="v").withColumnRenamed("k", "j")
    db = linalg.cells_matmul(a.select(F.col("k").alias("i2"), F.col("i").alias("k2"), "v"), g,
                             a_keys=("i2", "k2"), b_keys=("i", "j"), out="v").withColumnRenamed("i2", "k")
    return da, db


def grad_accumulate(contributions: Sequence[DataFrame], keys: Sequence[str], g: str = "grad") -> DataFrame:
    """Sum every contribution to the same tensor cell (union + group by key)."""
    u = contributions[0].select(*keys, g)
    for c in contributions[1:]:
        u = u.unionByName(c.select(*keys, g))
    return u.groupBy(*keys).agg(F.sum(g).alias(g))


# ---------------------------------------------------------------- loss rules
def grad_cross_entropy_logits(probs, target, scale: float) -> Column:
    """d/dz of ``scale * sum_c -t ln(p + eps)`` with p = softmax(z): p * (g - sum(g p)), g = -t/(p+eps)."""
    from tablegrad.operators.losses import LOG_EPS
    return bind(probs, lambda pv: grad_softmax(
        pv, F.zip_with(pv, col(target), lambda p, t: -t / (p + F.lit(LOG_EPS)) * F.lit(scale))))


def grad_mse(pred, target, scale: float) -> Column:
    """d/dpred of ``scale * sum (pred - t)^2``."""
    return F.zip_with(col(pred), col(target), lambda p, t: F.lit(2.0 * scale) * (p - t))


__all__ = [n for n in dir() if n.startswith("grad_")] + ["ln_ieee"]
