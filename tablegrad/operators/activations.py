"""Activations: relu, sigmoid, softmax along any axis."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablegrad.functions.columns import arr_softmax, arr_unary
from tablegrad.operators.layout import numel


def act_relu(a) -> Column:
    return arr_unary("relu", a)


def act_sigmoid(a) -> Column:
    return arr_unary("sigmoid", a)


def softmax_last(a) -> Column:
    """Softmax over the last axis of row-layout tensors: per-row expression, no shuffle."""
    return arr_softmax(a)


def softmax_cells(cells: DataFrame, shape: Sequence[int], axis: int = -1, pos: str = "pos", v: str = "v",
                  out: str = "p") -> DataFrame:
    """Softmax along ``axis`` of an N-D tensor held as ``(pos, v)`` cells.

    A slice is every cell sharing the indices off ``axis``: key = (pos div (A*inner), pos % inner). The
    per-slice max and exp-sum are aggregates (partial aggregation map-side) joined back on the slice key.
    Adaptive execution broadcasts the statistics where they are small; slices are never gathered into one task, so a
    long axis does not become one group.
    """
    nd = len(shape)
    ax = axis + nd if axis < 0 else axis
    if not 0 <= ax < nd:
        raise ValueError(f"softmax: invalid axis {axis} for shape {tuple(shape)}")
    a_len = shape[ax]
    inner = numel(shape[ax + 1:])
    keyed = cells.select(pos, v, F.expr(f"(`{pos}` div {a_len * inner}) * {inner} + `{pos}` % {inner}").alias("_slice"))

    mx = keyed.groupBy("_slice").agg(F.max(v).alias("_m"))
    shifted = keyed.join(mx, "_slice").select(pos, "_slice", F.exp(F.col(v) - F.col("_m")).alias("_e"))
    tot = shifted.groupBy("_slice").agg(F.sum("_e").alias("_s"))
    return shifted.join(tot, "_slice").select(pos, (F.col("_e") / F.col("_s")).alias(out))


#: Width of the steps of exponents in the mergeable softmax state: exp of half a step and sums of as many terms as there are rows
#: are far from overflow, and terms two steps below the largest value are under 1e-111 of it.
STEP = 256.0


def _slices(shape: Sequence[int], axis: int, pos: str) -> Column:
    """The slice of a cell: its indices off ``axis``, as one number."""
    ax = axis + len(shape) if axis < 0 else axis
    if not 0 <= ax < len(shape):
        raise ValueError(f"softmax: invalid axis {axis} for shape {tuple(shape)}")
    inner = numel(shape[ax + 1:])
    return F.expr(f"(`{pos}` div {shape[ax] * inner}) * {inner} + `{pos}` % {inner}")


def log_sum_exp_by(cells: DataFrame, keys: Sequence[str], v: str = "v", out: str = "lse") -> DataFrame:
    """log(sum(exp(v))) of each group in one pass over the cells, whatever the size of v.

    The state of a group is the nearest multiple of STEP to its largest value and the sum of exp(v - that multiple); sums of one
    step are added, so they combine map-side, and only the top two steps of a group count (neighbours, so one is even and one
    odd). A group may be as long as the table. All values -inf give -inf; +inf or NaN gives NaN, as the usual shifted form does.
    """
    x = F.col(v)
    none, odd = x == F.lit(float("-inf")), F.isnan(x) | (x == F.lit(float("inf")))
    step = F.when(~none & ~odd, F.rint(x / STEP))
    term = F.when(odd, F.lit(float("nan"))).when(none, F.lit(0.0)).otherwise(F.exp(x - step * STEP))
    sums = cells.select(*keys, step.alias("_e"), term.alias("_t")).groupBy(*keys, "_e").agg(F.sum("_t").alias("_s"))
    parity = F.pmod(F.col("_e"), F.lit(2.0))
    states = sums.groupBy(*keys).agg(*(F.max(F.when(parity == p, F.struct("_e", "_s"))).alias(f"_{p}") for p in (0, 1)),
                                     F.max(F.isnan("_s")).alias("_odd"))
    up, low = F.greatest("_0", "_1"), F.least("_0", "_1")  # structs compare by step first; a missing one is skipped
    near = F.when(low["_e"] == up["_e"] - 1, low["_s"] * F.exp(F.lit(-STEP))).otherwise(F.lit(0.0))
    lse = (F.when(F.col("_odd"), F.lit(float("nan"))).when(up.isNull(), F.lit(float("-inf")))
           .otherwise(up["_e"] * STEP + F.ln(up["_s"] + near)))
    return states.select(*keys, lse.alias(out))


def log_sum_exp(cells: DataFrame, shape: Sequence[int], axis: int = -1, pos: str = "pos", v: str = "v", out: str = "lse") -> DataFrame:
    """log(sum(exp(v))) along ``axis`` of ``(pos, v)`` cells -> ``(pos, lse)`` of the tensor without that axis."""
    keyed = cells.select(_slices(shape, axis, pos).alias("_slice"), v)
    return log_sum_exp_by(keyed, ["_slice"], v, out).withColumnRenamed("_slice", pos)


def softmax_stream(cells: DataFrame, shape: Sequence[int], axis: int = -1, pos: str = "pos", v: str = "v", out: str = "p") -> DataFrame:
    """Softmax along ``axis`` of ``(pos, v)`` cells by one aggregate and one join: exp(v - log_sum_exp)."""
    keyed = cells.select(pos, v, _slices(shape, axis, pos).alias("_slice"))
    lse = log_sum_exp_by(keyed, ["_slice"], v, "_lse")
    return keyed.join(lse, "_slice").select(pos, F.exp(F.col(v) - F.col("_lse")).alias(out))
