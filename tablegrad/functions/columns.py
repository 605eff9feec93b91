"""Column-level building blocks (all JVM-side Spark expressions).

Tensors in row layout are ``ARRAY<DOUBLE>`` columns; every helper here returns a Column so it composes inside
``select`` and stays in the optimizer's hands. IEEE semantics are restored where Spark's ANSI mode differs
(1/0 raises, ln(0) is NULL).
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F

INF = float("inf")
NAN = float("nan")


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def as_double_array(c) -> Column:
    """Widen an array of float/int to ARRAY<DOUBLE> before any arithmetic."""
    return F.transform(col(c), lambda x: x.cast("double"))


def tidy(c, digits: int = 6) -> Column:
    """Round for comparison and fold -0.0 into 0.0.

    ``round(x * 10^d) / 10^d`` rather than ``round(x, d)``: the scaled double is the same IEEE value in every
    engine, so half-way cases round alike (``round(x, d)`` goes through a decimal string in Spark).
    """
    scale = float(10 ** digits)
    return F.round(col(c) * F.lit(scale)) / F.lit(scale) + F.lit(0.0)


# ---------------------------------------------------------------- scalar maths with IEEE results
def ln_ieee(x: Column) -> Column:
    return (F.when(x.isNull(), F.lit(None).cast("double"))
            .when(F.isnan(x), F.lit(NAN))
            .when(x == 0, F.lit(-INF))
            .when(x < 0, F.lit(NAN))
            .otherwise(F.ln(x)))


def reciprocal_ieee(x: Column) -> Column:
    return F.when(x == 0, F.lit(INF)).otherwise(F.lit(1.0) / x)


def relu(x: Column) -> Column:
    return F.when((x > 0) & ~F.isnan(x), x).otherwise(F.lit(0.0))


def relu_grad(x: Column) -> Column:
    return F.when((x > 0) & ~F.isnan(x), F.lit(1.0)).otherwise(F.lit(0.0))


def sigmoid(x: Column) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-x))


UNARY = {
    "neg": lambda x: -x,
    "sqrt": lambda x: F.pow(x, F.lit(0.5)),
    "reciprocal": reciprocal_ieee,
    "log": ln_ieee,
    "relu": relu,
    "sigmoid": sigmoid,
    "exp": F.exp,
}


def unary(op: str, x: Column, p: float | None = None) -> Column:
    if op == "pow":
        return F.pow(x, F.lit(float(p)))
    return UNARY[op](x)


BINARY = {
    "add": lambda a, b: a + b,
    "sub": lambda a, b: a - b,
    "mul": lambda a, b: a * b,
}


# ---------------------------------------------------------------- array (row layout) helpers
def arr_unary(op: str, a, p: float | None = None) -> Column:
    return F.transform(col(a), lambda x: unary(op, x, p))


def arr_binary(op: str, a, b) -> Column:
    fn = BINARY[op]
    return F.zip_with(col(a), col(b), lambda x, y: fn(x, y))


def arr_scalar(op: str, a, s) -> Column:
    fn = BINARY[op]
    if isinstance(s, Column):
        return let(s, lambda sv: F.transform(col(a), lambda x: fn(x, sv)))
    return F.transform(col(a), lambda x: fn(x, F.lit(float(s))))


def arr_sum(a) -> Column:
    return F.aggregate(col(a), F.lit(0.0), lambda acc, x: acc + x)


def arr_dot(a, b) -> Column:
    return arr_sum(F.zip_with(col(a), col(b), lambda x, y: x * y))


def arr_mean(a) -> Column:
    return arr_sum(a) / F.size(col(a))


def let(expr, fn) -> Column:
    """Evaluate ``expr`` once per row and pass it to ``fn`` as a lambda variable.

    Lambda bodies re-evaluate outer expressions on every element; binding through a one-element ``transform``
    keeps a nested forward pass linear in its depth.
    """
    return F.element_at(F.transform(F.array(col(expr)), fn), 1)


def bind(a, fn) -> Column:
    """``let`` for names too: the optimizer may inline a computed column into a lambda body (CollapseProject
    counts one syntactic reference), which would recompute it per element."""
    return let(col(a), fn)


def arr_softmax(a) -> Column:
    """Max-shifted softmax of one array; no shuffle, O(n) per row.

    The max and the sum are bound as lambda variables through ``aggregate(..., finish)`` so they are computed
    once per row instead of once per element.
    """
    def body(av):
        def with_max(m):
            e = F.transform(av, lambda x: F.exp(x - m))
            return F.aggregate(e, F.lit(0.0), lambda acc, x: acc + x, lambda s: F.transform(e, lambda x: x / s))

        return F.aggregate(av, F.lit(-INF), lambda acc, x: F.greatest(acc, x), with_max)

    return bind(a, body)


def argmax(a) -> Column:
    a = col(a)
    return (F.array_position(a, F.array_max(a)) - 1).cast("int")


def lit_array(values: Sequence[float]) -> Column:
    return F.array(*[F.lit(float(v)) for v in values])


def lit_matrix_cols(w: np.ndarray) -> Column:
    """A [k, n] matrix as a literal array of its n columns (each of length k)."""
    w = np.asarray(w, dtype=np.float64)
    return F.array(*[lit_array(w[:, j]) for j in range(w.shape[1])])


def vec_matmul(a, w: np.ndarray, b: np.ndarray | None = None) -> Column:
    """Row vector times a driver-held [k, n] matrix (+ bias): map-side, no shuffle."""
    cols = lit_matrix_cols(w)
    out = bind(a, lambda av: F.transform(cols, lambda wc: arr_dot(av, wc)))
    if b is not None:
        out = arr_binary("add", out, lit_array(np.asarray(b, dtype=np.float64)))
    return out


def one_hot(label, num_classes: int) -> Column:
    """One-hot of an integer-valued column; values outside [0, C) fail the job (assert_true)."""
    lab = col(label)
    checked = F.when(
        F.assert_true((lab >= 0) & (lab < num_classes) & lab.isNotNull(),
                      F.lit(f"one_hot: label outside [0, {num_classes})")).isNull(),
        lab.cast("int"))
    return let(checked, lambda lv: F.transform(F.sequence(F.lit(0), F.lit(num_classes - 1)),
                                               lambda c: F.when(c == lv, F.lit(1.0)).otherwise(F.lit(0.0))))


def size_guard(a, expected: int, what: str = "tensor") -> Column:
    """Pass ``a`` through, failing the job when its length differs from ``expected``."""
    a = col(a)
    return F.when(F.assert_true(F.size(a) == expected,
                                F.lit(f"{what}: expected size {expected}")).isNull(), a)
