"""Training of models larger than the driver: parameters, moments, activations and gradients are tables of tiles.

The state is one table of parameter blocks, ``(param_id, bi, bj, nr, nc, data, m, v)``: a block's values and its optimizer moments
lie in one row. A layer's forward and backward products are tile products (``operators.tiles``), so a task reads only the blocks it
multiplies; the gradient of a layer comes out as tiles with the same places, and the optimizer is one join of the state and
the gradients, block by block. The driver sees one loss a step and never a tensor.

Tables of a step are deleted when the next state is written.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablegrad.functions import kernels
from tablegrad.functions.arrow import column
from tablegrad.operators import tiles
from tablegrad.operators.batching import rank_within
from tablegrad.operators.nn import Linear, ReLU, Sigmoid, param_specs
from tablegrad.operators.tiles import NAMES, Tiles, _matrices
from tablegrad.session import drop_table, scratch_path

STATE = "param_id int, bi bigint, bj bigint, nr int, nc int, data binary, m binary, v binary"


@dataclass
class BlockConfig:
    loss: str = "cross_entropy"     # 'cross_entropy' (mean over rows x classes) | 'mse'
    optimizer: str = "sgd"          # 'sgd' | 'adam'
    steps: int = 1
    lr: float = 0.01
    beta1: float = 0.9
    beta2: float = 0.999
    eps: float = 1e-8
    size: int = tiles.SIZE


def _shape(shape: tuple) -> tuple[int, int]:
    return shape if len(shape) == 2 else (1, shape[0])


def state_of(params: DataFrame, layers, size: int) -> DataFrame:
    """A parameter table ``(param_id, name, pos, value)`` as parameter blocks; every place once."""
    out = None
    for k, (_, shape) in enumerate(param_specs(layers)):
        m, n = _shape(shape)
        own = params.where(F.col("param_id") == k).select(F.expr(f"pos div {n}").alias("i"), (F.col("pos") % n).alias("j"), F.col("value").alias("v"))
        t = tiles.from_cells(own, m, n, size).df.select(F.lit(k).alias("param_id"), *NAMES, F.lit(None).cast("binary").alias("m"), F.lit(None).cast("binary").alias("v"))
        out = t if out is None else out.unionByName(t)
    return out


def params_of(state: DataFrame, layers, size: int) -> DataFrame:
    """Parameter blocks as ``(param_id, name, pos, value)``."""
    out = None
    for k, (name, shape) in enumerate(param_specs(layers)):
        m, n = _shape(shape)
        c = tiles.to_cells(_tensor(state, k, (m, n), size))
        c = c.select(F.lit(k).alias("param_id"), F.lit(name).alias("name"), (F.col("i") * n + F.col("j")).alias("pos"), F.col("v").alias("value"))
        out = c if out is None else out.unionByName(c)
    return out


def _tensor(state: DataFrame, k: int, shape: tuple[int, int], size: int) -> Tiles:
    return Tiles(state.where(F.col("param_id") == k).select(*NAMES), *shape, size)


def optimizer_step(state: DataFrame, grads: DataFrame, cfg: BlockConfig, t: int) -> DataFrame:
    """The next state: blocks joined with their gradients ``(param_id, bi, bj, grad)``; a block without one fails the job."""
    if cfg.optimizer not in ("sgd", "adam"):
        raise ValueError(f"unknown optimizer {cfg.optimizer}")

    def kernel(batches):
        for b in batches:
            rows = []
            for p, g, m, v in zip(column(b, "data").to_pylist(), column(b, "grad").to_pylist(), column(b, "m").to_pylist(), column(b, "v").to_pylist()):
                if p is None or g is None or len(p) != len(g):
                    raise ValueError("optimizer: a block has no gradient of its size")
                p, g = np.frombuffer(p), np.frombuffer(g)
                if cfg.optimizer == "sgd":
                    rows.append(((p - cfg.lr * g).tobytes(), None, None))
                    continue
                m = cfg.beta1 * (np.frombuffer(m) if m else 0.0) + (1 - cfg.beta1) * g
                v = cfg.beta2 * (np.frombuffer(v) if v else 0.0) + (1 - cfg.beta2) * g * g
                new = p - cfg.lr * (m / (1 - cfg.beta1 ** t)) / (np.sqrt(v / (1 - cfg.beta2 ** t)) + cfg.eps)
                rows.append((new.tobytes(), m.tobytes(), v.tobytes()))
            if rows:
                yield pa.RecordBatch.from_arrays([*(column(b, c) for c in ("param_id", "bi", "bj", "nr", "nc")), *(pa.array(c, pa.binary()) for c in zip(*rows))],
                                                 names=["param_id", "bi", "bj", "nr", "nc", "data", "m", "v"])

    return state.join(grads, ["param_id", "bi", "bj"], "full_outer").mapInArrow(kernel, STATE)


def _loss(z: Tiles, target: Tiles, cfg: BlockConfig) -> tuple[Tiles, DataFrame]:
    """The gradient of the mean loss by the outputs, and the sum of the row losses (one row)."""
    share, kind = 1.0 / (z.m * z.n), cfg.loss
    g = tiles.combine(z, target, lambda p, t: kernels.loss_and_grad(p, t, kind)[1] * share)

    def kernel(batches):
        total = 0.0
        for b in batches:
            total += sum(float(kernels.loss_and_grad(p, t, kind)[0].sum()) for p, t in zip(_matrices(b), _matrices(b, "other")))
        yield pa.RecordBatch.from_arrays([pa.array([total])], names=["loss"])

    both = z.df.join(target.df.select("bi", "bj", F.col("data").alias("other")), ["bi", "bj"])
    return g, both.mapInArrow(kernel, "loss double").agg((F.sum("loss") * share).alias("loss"))


def gradients(x: Tiles, target: Tiles, layers, state: DataFrame, cfg: BlockConfig, folder: str) -> tuple[DataFrame, float]:
    """Gradient tiles ``(param_id, bi, bj, grad)`` of all parameters, and the mean loss. Activations and upstream gradients are
    written under ``folder``."""
    specs, h, tape, k = param_specs(layers), x, [], 0
    for layer in layers:
        if isinstance(layer, Linear):
            w = _tensor(state, k, specs[k][1], cfg.size)
            tape.append((layer, h, w, k))
            z = tiles.matmul(h, w)
            if layer.bias:
                z = tiles.with_row(z, _tensor(state, k + 1, (1, layer.out_features), cfg.size), np.add)
            k += 1 + layer.bias
        elif isinstance(layer, (ReLU, Sigmoid)):
            z = tiles.map_tiles(h, lambda t, layer=layer: kernels.forward(t, [layer], [])[0])
            tape.append((layer, h, None, None))
        else:
            raise ValueError(f"blocks: no tiled form of {layer!r}")
        h = z.saved(folder)
    if h.n > cfg.size:
        raise ValueError(f"blocks: {h.n} outputs, more than a tile of {cfg.size} is wide")
    g, loss = _loss(h, target, cfg)
    g, found = g.saved(folder), []
    for layer, before, w, k in reversed(tape):
        if isinstance(layer, Linear):
            found.append((k, tiles.matmul(before, g, transpose_a=True)))
            if layer.bias:
                found.append((k + 1, tiles.column_sums(g)))
            if layer is not layers[0]:
                g = tiles.matmul(g, w, transpose_b=True).saved(folder)
        else:
            back = lambda p, t, layer=layer: kernels.backward_through(kernels.forward(t, [layer], [])[1], p)[1]
            g = tiles.combine(g, before, back).saved(folder)
    out = None
    for k, t in found:
        own = t.df.select(F.lit(k).alias("param_id"), "bi", "bj", F.col("data").alias("grad"))
        out = own if out is None else out.unionByName(own)
    return out, loss.first()["loss"]


def train_blocks(spark: SparkSession, df: DataFrame, id_col: str, features: str, target: str, layers, params: DataFrame,
                 cfg: BlockConfig) -> tuple[DataFrame, list[float]]:
    """(parameter table after ``cfg.steps`` full-batch steps, the mean loss before each step). Ids need not be dense."""
    base = scratch_path(spark, f"blocks-{uuid.uuid4().hex}")
    ranked = rank_within(df.select(id_col, features, target).withColumn("_part", F.lit(0)), "_part", id_col, out="_row")
    ranked.select("_row", features, target).write.parquet(f"{base}/samples")
    rows = spark.read.parquet(f"{base}/samples")
    first = rows.agg(F.count("*").alias("m"), F.max(F.size(features)).alias("f"), F.max(F.size(target)).alias("t")).first()
    if not first["m"]:
        return params, []
    x = tiles.from_rows(rows, first["m"], first["f"], cfg.size, "_row", features).saved(f"{base}/x")
    y = tiles.from_rows(rows, first["m"], first["t"], cfg.size, "_row", target).saved(f"{base}/y")
    state_of(params, layers, cfg.size).write.parquet(f"{base}/state-0")
    state = spark.read.schema(STATE).parquet(f"{base}/state-0")
    losses = []
    for t in range(1, cfg.steps + 1):
        grads, loss = gradients(x, y, layers, state, cfg, f"{base}/step-{t}")
        losses.append(loss)
        optimizer_step(state, grads, cfg, t).write.parquet(f"{base}/state-{t}")
        state = spark.read.schema(STATE).parquet(f"{base}/state-{t}")
        drop_table(spark, f"{base}/step-{t}")
        drop_table(spark, f"{base}/state-{t - 1}")
    for name in ("samples", "x", "y"):
        drop_table(spark, f"{base}/{name}")
    return params_of(state, layers, cfg.size), losses
