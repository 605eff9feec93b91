"""Gradients of a user's own expression: a graph of table operators, compiled into one backward plan.

A ``Graph`` stands on one table of rows. Its tensors have one of five kinds, told apart by where their axes lie:

* ``matrix`` [m, n] and ``column`` [m]: an array or a number in every row of the table, so any number of rows;
* ``vector`` [n] and ``scalar`` []: one value for the whole table, as wide as a row at most;
* ``weights`` [k, n]: a parameter matrix, held by the driver (applied by numpy over Arrow batches) or a table ``(k, j, v)``.

Building an expression only notes the operators. ``values`` and ``gradients`` order the graph topologically, so a tensor that
several others use is computed once, and the gradients that reach it are added up before they go on. Per-row tensors become
columns of the table, and the gradients of leaves become aggregates over these columns, so a graph whose reductions only end it
(a loss) is one lazy plan. Where a row needs a sum over all rows (the mean that it is centred by, or the gradient of that mean),
the sum is one aggregate job of its own: its value, no wider than a row, comes back to the driver and goes on as a literal.
The rules are those of ``operators.grads``.

Operands are broadcast as in numpy where one is a vector (along rows), a column (along the row's values) or a scalar; a gradient
is summed over the axes along which its tensor was repeated. Sizes that don't fit fail the job.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablegrad.functions import columns as C
from tablegrad.operators import grads, linalg
from tablegrad.operators.elementwise import ew_binary
from tablegrad.operators.losses import LOG_EPS
from tablegrad.session import scratch_path

PER_ROW = ("matrix", "column")
ARRAYS = ("matrix", "vector")
UNARY = ("neg", "pow", "sqrt", "reciprocal", "log", "relu", "sigmoid")


class Tensor:
    """A node: its kind, the operator that made it and that operator's inputs."""

    def __init__(self, graph: Graph, kind: str, op: str, inputs: Sequence[Tensor] = (), arg=None):
        self.graph, self.kind, self.op, self.inputs, self.arg = graph, kind, op, tuple(inputs), arg

    def _with(self, other, op: str, swapped: bool = False) -> Tensor:
        other = other if isinstance(other, Tensor) else self.graph.scalar(other)
        a, b = (other, self) if swapped else (self, other)
        kinds = {a.kind, b.kind}
        if "weights" in kinds or kinds == {"column", "vector"}:
            raise ValueError(f"{op}: {a.kind} and {b.kind} don't broadcast")
        kind = next(k for k in ("matrix", "column", "vector", "scalar") if k in kinds)
        return Tensor(self.graph, kind, op, (a, b))

    def __add__(self, other): return self._with(other, "add")
    def __radd__(self, other): return self._with(other, "add", True)
    def __sub__(self, other): return self._with(other, "sub")
    def __rsub__(self, other): return self._with(other, "sub", True)
    def __mul__(self, other): return self._with(other, "mul")
    def __rmul__(self, other): return self._with(other, "mul", True)

    def _unary(self, op: str, p: float | None = None) -> Tensor:
        if self.kind == "weights":
            raise ValueError(f"{op}: not for weights")
        return Tensor(self.graph, self.kind, op, (self,), p)

    def __neg__(self): return self._unary("neg")
    def pow(self, p: float): return self._unary("pow", float(p))
    def sqrt(self): return self._unary("sqrt")
    def reciprocal(self): return self._unary("reciprocal")
    def log(self): return self._unary("log")
    def relu(self): return self._unary("relu")
    def sigmoid(self): return self._unary("sigmoid")
    def __truediv__(self, other): return self * (other.reciprocal() if isinstance(other, Tensor) else 1.0 / other)

    def softmax(self) -> Tensor:
        """Along the values of a row (or of a vector)."""
        if self.kind not in ARRAYS:
            raise ValueError("softmax: a matrix or a vector is needed")
        return Tensor(self.graph, self.kind, "softmax", (self,))

    def _reduce(self, op: str, axis: int | None) -> Tensor:
        to = {("matrix", None): "scalar", ("matrix", 0): "vector", ("matrix", 1): "column", ("column", None): "scalar",
              ("column", 0): "scalar", ("vector", None): "scalar", ("vector", 0): "scalar"}.get((self.kind, axis))
        if to is None:
            raise ValueError(f"{op}: no axis {axis} in a {self.kind}")
        return Tensor(self.graph, to, op, (self,))

    def sum(self, axis: int | None = None): return self._reduce("sum", axis)
    def mean(self, axis: int | None = None): return self._reduce("mean", axis)

    def __matmul__(self, other: Tensor) -> Tensor:
        to = {("matrix", "weights"): "matrix", ("matrix", "vector"): "column", ("vector", "weights"): "vector",
              ("vector", "vector"): "scalar"}.get((self.kind, other.kind))
        if to is None:
            raise ValueError(f"matmul: no product of {self.kind} and {other.kind}")
        return Tensor(self.graph, to, "matmul", (self, other))


class Graph:
    """Tensors over the rows of one table; ``id_col`` names a row in results."""

    def __init__(self, rows: DataFrame, id_col: str = "row_id"):
        self.rows, self.id_col = rows, id_col

    def matrix(self, col: str) -> Tensor:
        return Tensor(self, "matrix", "leaf", arg=col)

    def column(self, col: str) -> Tensor:
        return Tensor(self, "column", "leaf", arg=col)

    def vector(self, values) -> Tensor:
        """An array, or a table ``(j, v)``."""
        return Tensor(self, "vector", "leaf", arg=values)

    def scalar(self, value: float) -> Tensor:
        return Tensor(self, "scalar", "leaf", arg=float(value))

    def weights(self, values) -> Tensor:
        """A matrix that the driver holds, or a table ``(k, j, v)``."""
        return Tensor(self, "weights", "leaf", arg=values if isinstance(values, DataFrame) else np.asarray(values, dtype=np.float64))

    def mse(self, pred: Tensor, target: Tensor) -> Tensor:
        return (pred - target).pow(2.0).mean()

    def cross_entropy(self, logits: Tensor, target: Tensor) -> Tensor:
        return (-(target * (logits.softmax() + LOG_EPS).log())).mean()

    def values(self, *tensors: Tensor) -> list[DataFrame]:
        plan = _Plan(self)
        for t in topological(tensors):
            plan.forward(t)
        return [plan.table(t, plan.value[t] if t.kind in PER_ROW else plan.number(t), "v") for t in tensors]

    def gradients(self, root: Tensor, wrt: Sequence[Tensor], seed: float | str | None = None, save: bool = False) -> list[DataFrame]:
        """d(root) / d(each of ``wrt``): rows ``(id, grad)`` for per-row tensors, ``(j, grad)``, ``(k, j, grad)`` or ``(grad)``.

        The upstream gradient of ``root`` is 1 in every place, or ``seed``: a number, or a column of the table in the
        root's kind. ``save`` writes the rows with their forward values to the shared folder, so that every aggregate of
        the backward pass reads them instead of computing them again.
        """
        order = topological([root])
        plan = _Plan(self)
        for t in order:
            plan.forward(t)
        if save:
            plan.save()
        needed = set(wrt)
        for t in order:  # only tensors on a way to one of ``wrt``
            if any(i in needed for i in t.inputs):
                needed.add(t)
        upstream: dict[Tensor, list] = {root: [plan.seed(root, seed)]}
        total = {}
        for t in reversed(order):
            if t not in needed or t not in upstream:
                continue
            total[t] = plan.accumulate(t, upstream.pop(t))
            if t.op != "leaf":
                for i, g in zip(t.inputs, plan.backward(t, total[t], [i in needed for i in t.inputs])):
                    if g is not None:
                        upstream.setdefault(i, []).append(g)
        return [plan.table(t, total[t] if t in total else plan.zeros(t), "grad") for t in wrt]


def topological(roots: Sequence[Tensor]) -> list[Tensor]:
    """Every tensor that the roots need, inputs first, without recursion."""
    order, done, stack = [], set(), [(t, False) for t in reversed(roots)]
    while stack:
        t, inputs_done = stack.pop()
        if t in done:
            continue
        if inputs_done:
            done.add(t)
            order.append(t)
            continue
        stack.append((t, True))
        stack.extend((i, False) for i in reversed(t.inputs) if i not in done)
    return order


def _arrays(df: DataFrame, kind: str, v: str = "v") -> np.ndarray:
    """A parameter-sized table ``(j, v)`` or ``(k, j, v)`` as an array; every cell once, none missing."""
    keys = ["k", "j"] if kind == "weights" else ["j"]
    got = df.select(*keys, v).toArrow()
    at = [got[c].to_numpy() for c in keys]
    shape = tuple(int(x.max()) + 1 if len(x) else 0 for x in at)
    flat = np.ravel_multi_index(at, shape) if got.num_rows else np.zeros(0, np.int64)
    if (np.bincount(flat, minlength=int(np.prod(shape))) != 1).any():
        raise ValueError(f"{kind}: a cell is missing or there twice")
    out = np.empty(int(np.prod(shape)))
    out[flat] = got[v].to_numpy()
    return out.reshape(shape)


_NP = {
    "neg": lambda x, p: -x, "pow": lambda x, p: x ** p, "sqrt": lambda x, p: np.sqrt(x), "reciprocal": lambda x, p: 1.0 / x,
    "log": lambda x, p: np.log(x), "relu": lambda x, p: np.where(x > 0, x, 0.0), "sigmoid": lambda x, p: 1.0 / (1.0 + np.exp(-x))}
_NP_SLOPE = {
    "neg": lambda x, p: -1.0, "pow": lambda x, p: p * x ** (p - 1.0), "sqrt": lambda x, p: 0.5 / np.sqrt(x), "reciprocal": lambda x, p: -1.0 / (x * x),
    "log": lambda x, p: 1.0 / x, "relu": lambda x, p: (x > 0) * 1.0, "sigmoid": lambda x, p: _NP["sigmoid"](x, p) * (1.0 - _NP["sigmoid"](x, p))}
_NP_BINARY = {"add": np.add, "sub": np.subtract, "mul": np.multiply}


def _np_softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max())
    return e / e.sum()


class _Plan:
    """A graph being compiled: a column of the rows for each per-row tensor, an array for each other one that is needed."""

    def __init__(self, graph: Graph):
        self.graph, self.rows, self.spark = graph, graph.rows, graph.rows.sparkSession
        self.value: dict[Tensor, Column] = {}
        self.known: dict[Tensor, np.ndarray] = {}
        self.counted = False

    # ------------------------------------------------------------ places for values
    def put(self, expr: Column) -> Column:
        """``expr`` as a column of the rows."""
        name = self._name()
        self.rows = self.rows.withColumn(name, expr)
        return F.col(name)

    def _name(self) -> str:
        return f"_t{len(self.rows.columns)}"

    def save(self) -> None:
        path = scratch_path(self.spark, f"graph-{uuid.uuid4().hex}")
        schema = self.rows.schema
        self.rows.write.parquet(path)
        self.rows = self.spark.read.schema(schema).parquet(path)

    def number_of_rows(self) -> Column:
        """As a column: the one subquery of a plan, over the table as it was given."""
        if not self.counted:
            self.rows = self.rows.withColumn("_m", self.graph.rows.agg(F.count("*").cast("double").alias("m")).scalar())
            self.counted = True
        return F.col("_m")

    def over_rows(self, expr: Column, kind: str, mean: bool = False) -> DataFrame:
        """Sums (or means) over the rows as a table ``(j, v)``: of each value of an array, or of a number (j = 0)."""
        if kind == "scalar":
            return self.rows.agg(F.lit(0).alias("j"), F.coalesce(F.avg(expr) if mean else F.sum(expr), F.lit(0.0)).alias("v"))
        cells = self.rows.select(F.posexplode(expr).alias("j", "x"))
        return cells.groupBy("j").agg((F.avg("x") if mean else F.sum("x")).alias("v"))

    def of(self, t: Tensor) -> Column:
        """The value of a tensor next to every row."""
        if t.kind in PER_ROW:
            return self.value[t]
        return self._literal(self.number(t))

    @staticmethod
    def _literal(x: np.ndarray) -> Column:
        return C.lit_array(x) if np.ndim(x) else F.lit(float(x))

    def number(self, t: Tensor) -> np.ndarray:
        """The value of a tensor that has none per row."""
        if t not in self.known:
            self.known[t] = self._compute(t)
        return self.known[t]

    def _compute(self, t: Tensor):
        if t.op == "leaf":
            return _arrays(t.arg, t.kind) if isinstance(t.arg, DataFrame) else np.asarray(t.arg, dtype=np.float64)
        a = t.inputs[0]
        if t.op in ("sum", "mean") and a.kind in PER_ROW:
            return self._over(a, t.op == "mean") if t.kind == "vector" else self._over_all(a, t.op == "mean")
        v = [self.number(i) for i in t.inputs]
        if t.op in _NP_BINARY:
            return _NP_BINARY[t.op](*v)
        if t.op in UNARY:
            return _NP[t.op](v[0], t.arg)
        return {"softmax": lambda: _np_softmax(v[0]), "matmul": lambda: v[0] @ v[1], "sum": lambda: v[0].sum(), "mean": lambda: v[0].mean()}[t.op]()

    def _over(self, a: Tensor, mean: bool) -> np.ndarray:
        return _arrays(self.over_rows(self.value[a], "vector", mean), "vector")

    def _over_all(self, a: Tensor, mean: bool) -> np.ndarray:
        x = self.value[a]
        inner = (C.arr_mean(x) if mean else C.arr_sum(x)) if a.kind == "matrix" else x
        return np.asarray(self.over_rows(inner, "scalar", mean).first()["v"])

    def table(self, t: Tensor, value, out: str) -> DataFrame:
        if t.kind in PER_ROW:
            return self.rows.select(self.graph.id_col, value.alias(out))
        if isinstance(value, DataFrame):
            keys = {"weights": ["k", "j"], "vector": ["j"], "scalar": []}[t.kind]
            return value.select(*keys, F.col("v").alias(out))
        return self._small(t.kind, value, out)

    def _small(self, kind: str, x: np.ndarray, out: str = "v") -> DataFrame:
        """An array as the table that stands for its kind."""
        x = np.asarray(x, dtype=np.float64)
        keys = {"k": np.repeat(np.arange(x.shape[0]), x.shape[1]), "j": np.tile(np.arange(x.shape[1]), x.shape[0])} if kind == "weights" else \
            {"j": np.arange(len(x))} if kind == "vector" else {}
        return self.spark.createDataFrame(pa.table({k: pa.array(i.astype(np.int32)) for k, i in keys.items()} | {out: pa.array(x.ravel())}))

    # ------------------------------------------------------------ elementwise with broadcasting
    @staticmethod
    def _binary(op: str, ka: str, a: Column, kb: str, b: Column) -> Column:
        if ka in ARRAYS and kb in ARRAYS:
            return ew_binary(a, b, op)
        if ka in ARRAYS:
            return C.arr_scalar(op, a, b)
        if kb in ARRAYS:
            return C.let(a, lambda s: F.transform(b, lambda x: C.BINARY[op](s, x)))
        return C.BINARY[op](a, b)

    # ------------------------------------------------------------ forward
    def forward(self, t: Tensor) -> None:
        if t.kind not in PER_ROW:
            return  # computed when another value needs it
        if t.op == "leaf":
            self.value[t] = F.col(t.arg)
            return
        a = t.inputs[0]
        if t.op == "matmul":
            self.value[t] = self._product(self.value[a], self.number(t.inputs[1]))
            return
        v, k = [self.of(i) for i in t.inputs], [i.kind for i in t.inputs]
        if t.op in C.BINARY:
            x = self._binary(t.op, k[0], v[0], k[1], v[1])
        elif t.op in UNARY:
            x = C.arr_unary(t.op, v[0], t.arg) if t.kind == "matrix" else C.unary(t.op, v[0], t.arg)
        elif t.op == "softmax":
            x = C.arr_softmax(v[0])
        else:
            x = C.arr_sum(v[0]) if t.op == "sum" else C.arr_mean(v[0])
        self.value[t] = self.put(x)

    def _product(self, a: Column, w: np.ndarray) -> Column:
        """Rows times a matrix (or a vector, giving a number a row): one broadcast, numpy over Arrow batches."""
        name, keep = self._name(), self.rows.columns
        self.rows = linalg.rows_times_small(self.rows.withColumn("_x", C.size_guard(a, len(w), "matmul")), w, vec_col="_x", out_col=name, keep=keep)
        return F.col(name) if w.ndim == 2 else self.put(F.element_at(name, 1))

    # ------------------------------------------------------------ backward
    def seed(self, t: Tensor, given):
        if isinstance(given, str):
            if t.kind not in PER_ROW:
                raise ValueError("a seed column needs a per-row root")
            return F.col(given)
        x = 1.0 if given is None else float(given)
        if t.kind in PER_ROW:
            return F.transform(self.value[t], lambda _: F.lit(x)) if t.kind == "matrix" else F.lit(x)
        return np.full_like(self.number(t), x) if t.kind != "scalar" else np.asarray(x)

    def zeros(self, t: Tensor):
        if t.kind in PER_ROW:
            return F.transform(self.value[t], lambda _: F.lit(0.0)) if t.kind == "matrix" else F.lit(0.0)
        return np.zeros_like(self.number(t))

    def accumulate(self, t: Tensor, parts: list):
        """All gradients that reach a tensor, added up: a column of the rows, a table for a leaf, an array for any other."""
        if t.kind in PER_ROW:
            g = parts[0]
            for p in parts[1:]:
                g = self._binary("add", t.kind, g, t.kind, p)
            return self.put(g)
        if t.op == "leaf" and any(isinstance(p, DataFrame) for p in parts):
            keys = ["k", "j"] if t.kind == "weights" else ["j"]
            tables = [p if isinstance(p, DataFrame) else self._small(t.kind, p) for p in parts]
            tables = [p if "j" in p.columns else p.withColumn("j", F.lit(0)) for p in tables]
            return tables[0] if len(tables) == 1 else grads.grad_accumulate(tables, keys, "v")
        return sum(self._array(t.kind, p) for p in parts)

    @staticmethod
    def _array(kind: str, g):
        if not isinstance(g, DataFrame):
            return g
        return np.asarray(g.first()["v"]) if kind == "scalar" else _arrays(g, kind)

    def _narrow(self, kind: str, g, to: str):
        """A gradient in ``kind``, summed over the axes along which a tensor of kind ``to`` was repeated."""
        if kind == to:
            return g
        if kind == "matrix":
            return C.arr_sum(g) if to == "column" else self.over_rows(g if to == "vector" else C.arr_sum(g), to)
        return self.over_rows(g, "scalar") if kind == "column" else np.asarray(g.sum())

    def backward(self, t: Tensor, g, needs: list[bool]) -> list:
        """The gradient of each input that needs one, in the input's kind (or as a table of its sums over the rows)."""
        if t.op == "matmul":
            return self._matmul_back(t, g, needs)
        if t.op in ("sum", "mean"):
            return [self._reduce_back(t, g)]
        rows = t.kind in PER_ROW
        k = [i.kind for i in t.inputs]
        times = (lambda i: self._binary("mul", t.kind, g, k[i], self.of(t.inputs[i]))) if rows else (lambda i: g * self.number(t.inputs[i]))
        if t.op in ("add", "sub"):
            minus = (F.transform(g, lambda x: -x) if t.kind == "matrix" else -g) if t.op == "sub" else g
            return [self._narrow(t.kind, x, to) if need else None for x, to, need in zip((g, minus), k, needs)]
        if t.op == "mul":
            return [self._narrow(t.kind, times(1 - i), k[i]) if needs[i] else None for i in (0, 1)]
        if not rows:
            x = self.number(t.inputs[0])
            if t.op == "softmax":
                y = self.number(t)
                return [y * (g - (g * y).sum())]
            return [g * _NP_SLOPE[t.op](x, t.arg)]
        x, y = self.of(t.inputs[0]), self.value[t]
        if t.op == "softmax":
            return [grads.grad_softmax(y, g)]
        if t.kind == "matrix":
            return [grads.grad_unary(t.op, x, g, p=t.arg, y=y)]
        return [F.element_at(grads.grad_unary(t.op, F.array(x), F.array(g), p=t.arg, y=F.array(y)), 1)]

    def _reduce_back(self, t: Tensor, g):
        """Every summand gets the sum's gradient; a mean's is shared by as many as there are."""
        a = t.inputs[0]
        if a.kind == "vector":
            x = self.number(a)
            return np.full_like(x, float(g) / (len(x) if t.op == "mean" else 1))
        x = self.value[a]
        up = g if t.kind == "column" else self._literal(g)
        if t.op == "mean":
            share = F.size(x).cast("double") if a.kind == "matrix" and t.kind != "vector" else F.lit(1.0)
            share = share * self.number_of_rows() if t.kind != "column" else share
            up = C.arr_scalar("mul", up, 1.0 / share) if t.kind == "vector" else up / share
        if t.kind == "vector":
            return self._binary("add", "matrix", F.transform(x, lambda _: F.lit(0.0)), "vector", up)
        return C.let(up, lambda s: F.transform(x, lambda _: s)) if a.kind == "matrix" else up

    def _matmul_back(self, t: Tensor, g, needs: list[bool]) -> list:
        a, b = t.inputs
        if a.kind == "vector":
            va, vb = self.number(a), self.number(b)
            return [vb @ g if vb.ndim == 2 else vb * g, np.outer(va, g) if vb.ndim == 2 else va * g]
        x, w = self.value[a], self.number(b)
        if b.kind == "vector":
            da = C.let(g, lambda s: F.transform(self._literal(w), lambda y: y * s)) if needs[0] else None
            return [da, self.over_rows(C.arr_scalar("mul", x, g), "vector") if needs[1] else None]
        da = self._product(g, w.T) if needs[0] else None
        return [da, linalg.outer_sum(self.rows.select(x.alias("_a"), g.alias("_g")), "_a", "_g") if needs[1] else None]
