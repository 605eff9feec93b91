"""Layers, parameter tables and model-level operators.

A model is a plain list of layer specs. Parameters are either driver-held numpy arrays (they are model-sized,
so bounded independently of the data) or a parameter table in layout P::

    (param_id INT, name STRING, pos INT, value DOUBLE)

ordered by ``(param_id, pos)``; ``pos`` is the row-major flat index inside the parameter tensor.
"""

from __future__ import annotations

from dataclasses import dataclass
from math import sqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablegrad.functions.columns import arr_softmax, arr_unary, col, lit_array, vec_matmul
from tablegrad.operators.layout import checked


@dataclass(frozen=True)
class Linear:
    in_features: int
    out_features: int
    bias: bool = True


@dataclass(frozen=True)
class ReLU:
    pass


@dataclass(frozen=True)
class Sigmoid:
    pass


@dataclass(frozen=True)
class Softmax:
    pass


@dataclass(frozen=True)
class BatchNorm1d:
    num_features: int
    momentum: float = 0.1
    eps: float = 1e-5
    affine: bool = True


@dataclass(frozen=True)
class CustomLayer:
    """A user's layer: numpy functions over a batch.

    ``forward(x, *params) -> (y, saved)`` and ``backward(saved, grad_y) -> (grad_x, [grad of each parameter])``;
    ``shapes`` names the parameters and ``init`` gives their first values from a random generator. ``width`` is the
    number of outputs where the layer changes it. The functions go to the tasks, so they must be picklable.
    """
    forward: object
    backward: object
    shapes: tuple = ()
    init: object = None
    width: int | None = None


def mlp(sizes, activation=ReLU, softmax_output=False) -> list:
    """``mlp([64, 16, 10])`` -> Linear, ReLU, Linear (+ Softmax)."""
    layers = []
    for k, (a, b) in enumerate(zip(sizes[:-1], sizes[1:])):
        layers.append(Linear(a, b))
        if k < len(sizes) - 2:
            layers.append(activation())
    if softmax_output:
        layers.append(Softmax())
    return layers


def param_specs(layers) -> list[tuple[str, tuple[int, ...]]]:
    """(name, shape) of every parameter tensor in registration order."""
    out = []
    for k, layer in enumerate(layers):
        if isinstance(layer, Linear):
            out.append((f"{k}.weight", (layer.in_features, layer.out_features)))
            if layer.bias:
                out.append((f"{k}.bias", (layer.out_features,)))
        elif isinstance(layer, BatchNorm1d) and layer.affine:
            out.append((f"{k}.gamma", (layer.num_features,)))
            out.append((f"{k}.beta", (layer.num_features,)))
        elif isinstance(layer, CustomLayer):
            out += [(f"{k}.{name}", shape) for name, shape in layer.shapes]
        elif not isinstance(layer, (ReLU, Sigmoid, Softmax, BatchNorm1d)):
            raise ValueError(f"unknown layer {layer!r}")
    return out


def init_params_np(layers, seed: int) -> list[np.ndarray]:
    """Uniform(+-sqrt(6/(in+out))) weights, Uniform(0,1) biases, gamma 1, beta 0 (seeded)."""
    rng = np.random.default_rng(seed)
    out = []
    for layer in layers:
        if isinstance(layer, Linear):
            bound = sqrt(6.0 / (layer.in_features + layer.out_features))
            out.append(rng.uniform(-bound, bound, (layer.in_features, layer.out_features)))
            if layer.bias:
                out.append(rng.uniform(0.0, 1.0, (layer.out_features,)))
        elif isinstance(layer, BatchNorm1d) and layer.affine:
            out.append(np.ones(layer.num_features))
            out.append(np.zeros(layer.num_features))
        elif isinstance(layer, CustomLayer) and layer.shapes:
            out += [np.asarray(a, dtype=np.float64) for a in layer.init(rng)]
    return out


def hashed_uniform(seed: int, *keys) -> Column:
    """A number in [0, 1) from integer keys and a seed, by integer arithmetic that any engine repeats.

    Two rounds of a congruential step modulo 2**31 - 1; independent of how the rows are partitioned.
    """
    m = 2147483647
    x = F.lit(seed % m).cast("bigint")
    for k in keys:
        x = ((x + F.col(k).cast("bigint") + 1) * 48271) % m
        x = (x * 69621 + 12345) % m
    return (x % 1000003) / F.lit(1000003.0)


def init_params_table(spark: SparkSession, layers, seed: int) -> DataFrame:
    """Uniform(+-sqrt(6/(in+out))) weights, Uniform(0,1) biases, gamma 1, beta 0, one row per parameter element."""
    specs = param_specs(layers)
    sizes = [int(np.prod(s)) for _, s in specs]
    starts = [int(x) for x in np.cumsum([0, *sizes])]
    lo, scale = [], []
    for name, _ in specs:
        layer, kind = layers[int(name.split(".")[0])], name.split(".")[1]
        bound = sqrt(6.0 / (layer.in_features + layer.out_features)) if kind == "weight" else 0.0
        a, b = {"weight": (-bound, 2 * bound), "bias": (0.0, 1.0), "gamma": (1.0, 0.0)}.get(kind, (0.0, 0.0))
        lo.append(a)
        scale.append(b)
    pid = sum((F.col("id") >= o).cast("int") for o in starts[1:-1]) if len(specs) > 1 else F.lit(0)
    at = lambda values: F.element_at(F.array(*[F.lit(v) for v in values]), F.col("param_id") + 1)
    x = spark.range(starts[-1]).withColumn("param_id", pid).withColumn("pos", F.col("id") - at(starts[:-1]))
    return x.select("param_id", at([n for n, _ in specs]).alias("name"), F.col("pos").cast("bigint").alias("pos"),
                    (at(lo) + at(scale) * hashed_uniform(seed, "param_id", "pos")).alias("value"))


def params_to_table(spark: SparkSession, layers, arrays: list[np.ndarray]) -> DataFrame:
    """Driver parameters -> layout P (model-sized, created once per step, as an Arrow table)."""
    specs = param_specs(layers)
    sizes = [int(np.prod(s)) for _, s in specs]
    if not specs:
        return spark.createDataFrame([], "param_id int, name string, pos bigint, value double")
    return spark.createDataFrame(pa.table({
        "param_id": pa.array(np.repeat(np.arange(len(specs), dtype=np.int32), sizes)),
        "name": pa.array(np.repeat([n for n, _ in specs], sizes)),
        "pos": pa.array(np.concatenate([np.arange(n, dtype=np.int64) for n in sizes])),
        "value": pa.array(np.concatenate([np.asarray(a, dtype=np.float64).ravel() for a in arrays]))}))


def table_to_params(df: DataFrame, layers, value: str = "value") -> list[np.ndarray]:
    """Layout P -> numpy, checking full coverage (load_params semantics: every slot exactly once)."""
    specs = param_specs(layers)
    sizes = np.array([int(np.prod(s)) for _, s in specs], dtype=np.int64)
    starts = np.r_[0, np.cumsum(sizes)]
    got = df.select("param_id", F.col("pos").cast("bigint").alias("pos"), F.col(value).alias("value")).toArrow()
    pid, pos, val = (got[c].to_numpy() for c in ("param_id", "pos", "value"))
    if len(pid) and ((pid < 0) | (pid >= len(sizes))).any() or len(pid) and ((pos < 0) | (pos >= sizes[pid])).any():
        raise ValueError("load_params: a slot outside the model")
    flat = starts[pid] + pos
    if (np.bincount(flat, minlength=int(starts[-1])) != 1).any():
        raise ValueError("load_params: parameters not covered exactly once")
    out = np.empty(int(starts[-1]))
    out[flat] = val
    return [out[a:a + n].reshape(shape) for a, n, (_, shape) in zip(starts, sizes, specs)]


def save_model(params: DataFrame, path: str, buffers: DataFrame | None = None) -> None:
    """Write layout P (and the buffer table) as Parquet under ``path``."""
    params.write.mode("overwrite").parquet(f"{path}/params")
    if buffers is not None:
        buffers.write.mode("overwrite").parquet(f"{path}/buffers")


def load_model(spark: SparkSession, path: str, with_buffers: bool = False):
    """The parameter table, or (parameters, buffers)."""
    params = spark.read.parquet(f"{path}/params")
    return (params, spark.read.parquet(f"{path}/buffers")) if with_buffers else params


def reset_buffers(buffers: DataFrame) -> DataFrame:
    """A buffer table ``(layer, j, running_mean, running_var)`` set back to mean 0 and variance 1."""
    return buffers.withColumn("running_mean", F.lit(0.0)).withColumn("running_var", F.lit(1.0))


def forward_rows(rows: DataFrame, layers, params: list[np.ndarray], vec_col: str = "vec", out_col: str = "out", keep=None,
                 bn_running=None) -> DataFrame:
    """Evaluation forward pass of any model: one broadcast of the parameters, numpy over Arrow batches."""
    from tablegrad.functions import kernels
    from tablegrad.functions.arrow import column, list_to_matrix, matrix_to_list
    keep = [c for c in rows.columns if c != vec_col] if keep is None else list(keep)
    param_specs(layers)
    sent = rows.sparkSession.sparkContext.broadcast([np.asarray(p, dtype=np.float64) for p in params])
    fields = [rows.schema[c] for c in keep]
    schema = T.StructType(fields + [T.StructField(out_col, T.ArrayType(T.DoubleType()))])

    def kernel(batches):
        for batch in batches:
            if batch.num_rows:
                y, _ = kernels.forward(list_to_matrix(column(batch, vec_col)), layers, sent.value, training=False, bn_running=bn_running)
                yield pa.RecordBatch.from_arrays([*(column(batch, c) for c in keep), matrix_to_list(y)], names=[*keep, out_col])

    return rows.select(*keep, vec_col).mapInArrow(kernel, schema)


def load_params(current: DataFrame, incoming: DataFrame) -> DataFrame:
    """copyFrom on tables: replace ``value`` by key, failing unless every slot is matched exactly once."""
    new = incoming.groupBy("param_id", "pos").agg(F.min("value").alias("_new"), F.count("*").alias("_n"))
    j = current.drop("value").join(new, ["param_id", "pos"], "full_outer")
    return j.select("param_id", "name", "pos",
                    checked(F.col("_new"), F.col("name").isNotNull() & F.col("_new").isNotNull() & (F.col("_n") == 1),
                            "load_params: size or shape mismatch").alias("value"))


def param_summary(params: DataFrame, value: str = "value") -> DataFrame:
    """Per parameter tensor: element count, L2 norm, mean."""
    return params.groupBy("param_id", "name").agg(F.count("*").alias("n"),
                                                   F.sqrt(F.sum(F.col(value) * F.col(value))).alias("l2"),
                                                   F.avg(value).alias("mean"))


# ---------------------------------------------------------------- forward plans (JVM expressions)
def forward_expr(x, layers, params: list[np.ndarray], bn_running=None) -> Column:
    """Inference forward pass as one nested array expression (no shuffle). BatchNorm uses running stats."""
    out = col(x)
    it = iter(params)
    for k, layer in enumerate(layers):
        if isinstance(layer, Linear):
            w = next(it)
            b = next(it) if layer.bias else None
            out = vec_matmul(out, w, b)
        elif isinstance(layer, ReLU):
            out = arr_unary("relu", out)
        elif isinstance(layer, Sigmoid):
            out = arr_unary("sigmoid", out)
        elif isinstance(layer, Softmax):
            out = arr_softmax(out)
        elif isinstance(layer, BatchNorm1d):
            g, bt = (next(it), next(it)) if layer.affine else (np.ones(layer.num_features), np.zeros(layer.num_features))
            rm, rv = (bn_running or {}).get(k, (np.zeros(layer.num_features), np.ones(layer.num_features)))
            scale = g / np.sqrt(np.asarray(rv) + layer.eps)
            shift = bt - np.asarray(rm) * scale
            out = F.zip_with(F.zip_with(out, lit_array(scale), lambda v, s: v * s), lit_array(shift),
                             lambda v, s: v + s)
        else:
            raise ValueError(f"unknown layer {layer!r}")
    return out


def batchnorm_train_cells(cells: DataFrame, batch_keys, gamma: np.ndarray, beta: np.ndarray, eps: float = 1e-5,
                          j: str = "j", x: str = "x", out: str = "y") -> DataFrame:
    """Training-mode batch norm on cells ``(batch_keys..., row keys..., j, x)``.

    Statistics are per (batch, feature): mean and biased variance, aggregated map-side and joined back on
    (batch, feature). Output: every input column plus ``out``.
    """
    keys = list(batch_keys) + [j]
    stats = cells.groupBy(*keys).agg(F.avg(x).alias("_mu"), F.var_pop(x).alias("_var"))
    g, b = lit_array(gamma), lit_array(beta)
    return (cells.join(stats, keys)
            .withColumn(out, (F.col(x) - F.col("_mu")) / F.sqrt(F.col("_var") + F.lit(eps))
                        * F.element_at(g, F.col(j) + 1) + F.element_at(b, F.col(j) + 1))
            .drop("_mu", "_var"))


def batchnorm_train_rows(rows: DataFrame, batch_keys, gamma: np.ndarray, beta: np.ndarray, eps: float = 1e-5,
                         vec_col: str = "vec", out_col: str = "y") -> DataFrame:
    """Training-mode batch norm of row vectors: whole batches meet in one task (one shuffle), numpy per batch.

    A task holds one batch and one Arrow batch at a time. Output: the other columns plus ``out_col``.
    """
    from tablegrad.functions.arrow import column, list_to_matrix, matrix_to_list
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keep = [c for c in rows.columns if c != vec_col]
    schema = T.StructType([rows.schema[c] for c in keep] + [T.StructField(out_col, T.ArrayType(T.DoubleType()))])

    def finish(table: pa.Table):
        if not table.num_rows:
            return
        keys = [table.column(k).to_numpy() for k in batch_keys]
        cut = np.flatnonzero(np.logical_or.reduce([np.diff(k) != 0 for k in keys])) + 1
        x = list_to_matrix(table.column(vec_col)).copy()
        for a, z in zip(np.r_[0, cut], np.r_[cut, len(x)]):
            own = x[a:z]
            mu = own.mean(axis=0)
            var = ((own - mu) ** 2).mean(axis=0)
            x[a:z] = (own - mu) / np.sqrt(var + eps) * gamma + beta
        out = table.select(keep).append_column(out_col, matrix_to_list(x))
        yield from out.combine_chunks().to_batches()

    def kernel(batches):
        held = None
        for batch in batches:
            if not batch.num_rows:
                continue
            t = pa.Table.from_batches([batch]) if held is None else pa.concat_tables([held, pa.Table.from_batches([batch])])
            last = np.logical_and.reduce([t.column(k).to_numpy() == t.column(k)[-1].as_py() for k in batch_keys])
            first = len(last) if not last.any() else int(np.flatnonzero(last)[0])
            yield from finish(t.slice(0, first))
            held = t.slice(first)
        if held is not None:
            yield from finish(held)

    return rows.repartition(n, *batch_keys).sortWithinPartitions(*batch_keys).mapInArrow(kernel, schema)


def batchnorm_eval_cells(cells: DataFrame, buffers: DataFrame, gamma: np.ndarray, beta: np.ndarray, eps: float = 1e-5,
                         j: str = "j", x: str = "x", out: str = "y") -> DataFrame:
    """Evaluation-mode batch norm of cells with a buffer table ``(j, running_mean, running_var)``, joined on ``j``.

    A feature without buffers fails the job. The buffers have one row a feature and go to every task: dealt by ``j``, the cells would
    meet in as many tasks as there are features.
    """
    b = buffers.select(F.col(j), F.col("running_mean").alias("_m"), F.col("running_var").alias("_v"))
    y = (F.col(x) - F.col("_m")) / F.sqrt(F.col("_v") + F.lit(eps)) * F.element_at(lit_array(gamma), F.col(j) + 1)
    there = checked(y + F.element_at(lit_array(beta), F.col(j) + 1), F.col("_m").isNotNull(), "batch norm: a feature has no buffers")
    return cells.join(F.broadcast(b), j, "left").withColumn(out, there).drop("_m", "_v")


def batchnorm_eval(a, running_mean, running_var, gamma, beta, eps: float = 1e-5) -> Column:
    """Evaluation-mode batch norm of an array column with driver-held running statistics."""
    scale = np.asarray(gamma) / np.sqrt(np.asarray(running_var) + eps)
    shift = np.asarray(beta) - np.asarray(running_mean) * scale
    return F.zip_with(F.zip_with(col(a), lit_array(scale), lambda v, s: v * s), lit_array(shift),
                      lambda v, s: v + s)


def running_stats(batch_stats: DataFrame, order_col: str, key_cols, momentum: float = 0.1, init_mean: float = 0.0,
                  init_var: float = 1.0, mean: str = "mean", var: str = "var") -> DataFrame:
    """Closed form of the EMA ``r <- (1-m) r + m s_k`` over ordered batches, per feature.

    ``order_col`` is a dense 0-based batch index, so r_n = (1-m)^n r_0 + sum_k m (1-m)^(n-1-k) s_k is one
    sum: no window, no sequential fold, no job while the plan is built, and no batch sequence is gathered into one task.
    """
    # sums weighted by (1-m)^(-k) would overflow, so ranges of 256 batches are summed first and then decayed to the end
    keep, last = F.lit(1.0 - momentum), F.max(F.col(order_col))
    chunk = F.floor(F.col(order_col) / 256)
    decay = F.pow(keep, (chunk * 256 + 255) - F.col(order_col))
    part = batch_stats.groupBy(*key_cols, chunk.alias("_chunk")).agg(
        F.sum(F.lit(momentum) * decay * F.col(mean)).alias("_sm"), F.sum(F.lit(momentum) * decay * F.col(var)).alias("_sv"),
        last.alias("_last"))
    ends = part.groupBy(*key_cols).agg(F.max("_last").alias("_n"))
    fade = F.pow(keep, F.col("_n") - (F.col("_chunk") * 256 + 255))
    agg = part.join(ends, list(key_cols)).groupBy(*key_cols, "_n").agg(F.sum(F.col("_sm") * fade).alias("_sm"), F.sum(F.col("_sv") * fade).alias("_sv"))
    base = F.pow(keep, F.col("_n") + 1)
    return agg.select(*key_cols, (base * init_mean + F.col("_sm")).alias("running_mean"), (base * init_var + F.col("_sv")).alias("running_var"))
