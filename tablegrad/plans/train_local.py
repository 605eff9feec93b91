"""Local training with averaging: every part takes its own optimizer steps, then the models are averaged by samples.

A round broadcasts the model; a part (``pmod(id, P)``) walks its own batches in order, one local step a batch or one for each of
``local_steps`` shares of its batches, starting from the common model. Each part yields its model times its samples as one packet,
and the packets are added by the tree reduction, so the driver sees one model-sized sum a round. Steps of one part follow one
another by definition; more parts make a round shorter. A task holds one step's sums and one Arrow batch.
"""

from __future__ import annotations

import copy
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablegrad.functions import kernels
from tablegrad.functions.arrow import column, list_to_matrix
from tablegrad.operators import packets
from tablegrad.operators.nn import BatchNorm1d
from tablegrad.plans.train import BLOCK, TrainConfig, k_norm_of, make_optimizer, prepare_samples


def local_models(samples: DataFrame, layers, params: list[np.ndarray], cfg: TrainConfig, local_steps: int | None = None) -> DataFrame:
    """One packet a part: its parameters after its own steps, times its samples, in blocks, with their number."""
    if any(isinstance(x, BatchNorm1d) for x in layers) and local_steps is not None:
        raise ValueError("batch norm needs a step for each batch")
    sent = samples.sparkSession.sparkContext.broadcast([np.asarray(p, dtype=np.float64) for p in params])
    k_norm, first = k_norm_of(layers, cfg), make_optimizer(cfg)
    whole = any(isinstance(x, BatchNorm1d) for x in layers)

    def kernel(batches):
        state: dict = {}

        def begin(part):
            state.update(part=part, step=None, rows=0, params=[p.copy() for p in sent.value], opt=copy.deepcopy(first))

        def add(x, y):
            if whole:  # a batch is kept until it is complete
                state["held"].append((x, y))
            else:
                _sum(x, y)
            state["seen"] += len(x)
            state["rows"] += len(x)

        def _sum(x, y):
            grads, _ = kernels.batch_gradient(x, y, layers, state["params"], cfg.loss, np.full(len(x), 1.0 / k_norm), cfg.reduction)
            for a, g in zip(state["acc"], grads):
                a += g

        def open_step(step):
            state.update(step=step, seen=0, held=[], acc=[np.zeros_like(p) for p in state["params"]])

        def close_step():
            if state.get("step") is None:
                return
            if whole:
                _sum(*(np.concatenate(c) for c in zip(*state["held"])))
            state["params"] = state["opt"].step(state["params"], [a / state["seen"] for a in state["acc"]])

        def packet():
            flat = np.concatenate([p.ravel() for p in state["params"]]) * state["rows"]
            blocks = range(max(1, math.ceil(len(flat) / BLOCK)))
            return pa.RecordBatch.from_arrays(
                [pa.array(blocks, pa.int32()), pa.array([flat[i * BLOCK:(i + 1) * BLOCK] for i in blocks], pa.list_(pa.float64())),
                 pa.array([state["rows"]] * len(blocks), pa.int64())], names=["block", "grad", "n"])

        for batch in batches:
            if not batch.num_rows:
                continue
            x, y = list_to_matrix(column(batch, "features")), list_to_matrix(column(batch, "target"))
            part, step = column(batch, "part").to_numpy(), column(batch, "step").to_numpy()
            edges = np.flatnonzero((np.diff(part) != 0) | (np.diff(step) != 0)) + 1
            for i, j in zip([0, *edges.tolist()], [*edges.tolist(), len(part)]):
                if state.get("part") != part[i]:
                    if state:
                        close_step()
                        yield packet()
                    begin(part[i])
                if state["step"] != step[i]:
                    close_step()
                    open_step(step[i])
                add(x[i:j], y[i:j])
        if state:
            close_step()
            yield packet()

    step = F.col("batch_id") if local_steps is None else F.col("batch_id") % local_steps
    rows = samples.withColumn("step", step).select("id", "features", "target", "part", "step")
    return rows.repartition("part").sortWithinPartitions("part", "step", "id").mapInArrow(kernel, "block int, grad array<double>, n bigint")


def train_local(spark: SparkSession, df: DataFrame, id_col: str, features: str, target: str, layers, params: list[np.ndarray],
                cfg: TrainConfig, local_steps: int | None = None, depth: int = 2) -> list[np.ndarray]:
    """The parameters after ``cfg.epochs`` rounds. Optimizer state is a part's own and begins anew each round."""
    import uuid

    from tablegrad.session import scratch_path
    path = scratch_path(spark, f"local-{uuid.uuid4().hex}")
    samples = prepare_samples(df, id_col, features, target, cfg)
    samples.write.parquet(path)
    samples = spark.read.schema(samples.schema).parquet(path)
    params = [np.asarray(p, dtype=np.float64) for p in params]
    size = sum(p.size for p in params)
    for _ in range(cfg.epochs):
        total = packets.tree_sum(local_models(samples, layers, params, cfg, local_steps), depth).toArrow()
        if not total.num_rows:
            return params  # no samples, no steps
        flat, n = np.zeros(size), total["n"][0].as_py()
        for b, g in zip(total["block"].to_pylist(), total["grad"]):
            flat[b * BLOCK:b * BLOCK + len(g)] = g.values.to_numpy(zero_copy_only=False)
        at, new = 0, []
        for p in params:
            new.append((flat[at:at + p.size] / n).reshape(p.shape))
            at += p.size
        params = new
    return params
