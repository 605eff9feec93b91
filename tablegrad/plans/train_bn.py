"""Batch norm over batches of any size: statistics are merged, samples never gathered.

Of each batch only (count, mean, M2) leave a task, one row a batch-norm layer, and are merged by Chan's formula; the rows get
their batch's mean and variance back by a join on the batch. Layers are done one after another, as each needs the ones before it.
The backward pass needs two summed vectors of a batch, sum(g) and sum(g * xhat), for each batch-norm layer from the last to the
first; a final pass gives the gradient packets. Every pass computes the forward values of its rows again from the samples, so
nothing but batch-sized vectors is written.

Samples may lie anywhere: a batch may be larger than a task, or all samples one batch.
"""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablegrad.functions import kernels
from tablegrad.functions.arrow import column, list_to_matrix
from tablegrad.operators.nn import BatchNorm1d, Linear
from tablegrad.plans.train import PACKET_SCHEMA, TrainConfig, k_norm_of, packets
from tablegrad.session import scratch_path

KEYS = ["part", "batch_id"]
#: Batches whose sums a task holds at once.
HELD = 1024
MOMENTS = "part int, batch_id bigint, n bigint, a array<double>, b array<double>"


def merge_moments(n1, mean1, m21, n2, mean2, m22):
    """(count, mean, M2) of two sets of rows together."""
    n = n1 + n2
    d = mean2 - mean1
    return n, mean1 + d * (n2 / n), m21 + m22 + d * d * (n1 * n2 / n)


def merge_sums(n1, a1, b1, n2, a2, b2):
    return n1 + n2, a1 + a2, b1 + b2


def _flush(held: dict) -> pa.RecordBatch:
    (part, batch), state = zip(*held), list(held.values())
    out = pa.RecordBatch.from_arrays(
        [pa.array(part, pa.int32()), pa.array(batch, pa.int64()), pa.array([s[0] for s in state], pa.int64()),
         pa.array([s[1] for s in state], pa.list_(pa.float64())), pa.array([s[2] for s in state], pa.list_(pa.float64()))], names=["part", "batch_id", "n", "a", "b"])
    held.clear()
    return out


def _by_batch(rows: DataFrame, states, merge) -> DataFrame:
    """One merged state a batch; ``states(batch) -> (part, batch_id, {batch: state})`` of the rows of an Arrow batch."""
    def first(batches):
        held: dict = {}
        for b in batches:
            if not b.num_rows:
                continue
            for key, s in states(b):
                held[key] = merge(*held[key], *s) if key in held else s
            if len(held) > HELD:
                yield _flush(held)
        if held:
            yield _flush(held)

    def second(batches):
        held: dict = {}
        for b in batches:
            a, c = list_to_matrix(column(b, "a")), list_to_matrix(column(b, "b"))
            for i, (part, batch, n) in enumerate(zip(*(column(b, k).to_pylist() for k in ("part", "batch_id", "n")))):
                key = (part, batch)
                if held and key not in held:
                    yield _flush(held)
                held[key] = merge(*held[key], n, a[i], c[i]) if key in held else (n, a[i], c[i])
        if held:
            yield _flush(held)

    return rows.mapInArrow(first, MOMENTS).repartition(*KEYS).sortWithinPartitions(*KEYS).mapInArrow(second, MOMENTS)


def _groups(b: pa.RecordBatch):
    """(key, rows) of each batch in an Arrow batch."""
    keys = np.stack([column(b, k).to_numpy().astype(np.int64) for k in KEYS], 1)
    found, inverse = np.unique(keys, axis=0, return_inverse=True)
    order = np.argsort(inverse.ravel(), kind="stable")
    ends = np.cumsum(np.bincount(inverse.ravel()))
    for k, i, j in zip(found.tolist(), np.r_[0, ends[:-1]], ends):
        yield tuple(k), order[i:j]


def _forward(x, layers, params, known, upto=None):
    """Values before layer ``upto`` (or the output) and what the way back needs; batch norm by its batch's statistics."""
    it, tape = iter(params), []
    for k, layer in enumerate(layers):
        if isinstance(layer, BatchNorm1d):
            if k == upto:
                return x, tape
            gamma, beta = (next(it), next(it)) if layer.affine else (np.ones(layer.num_features), np.zeros(layer.num_features))
            inv = 1.0 / np.sqrt(known[f"v{k}"] + layer.eps)
            xhat = (x - known[f"m{k}"]) * inv
            tape.append(("bn", k, xhat, inv, gamma, layer.affine))
            x = xhat * gamma + beta
        else:
            own = [next(it) for _ in range((1 + layer.bias) if isinstance(layer, Linear) else len(getattr(layer, "shapes", ())))]
            x, part = kernels.forward(x, [layer], own)
            tape.append(("layer", part))
    return x, tape


def _backward(tape, g, known, downto=None):
    """(parameter gradients in order) or, with ``downto``, (g * gamma, xhat) at that batch-norm layer."""
    grads = []
    for entry in reversed(tape):
        if entry[0] == "layer":
            own, g = kernels.backward_through(entry[1], g)
            grads.extend(reversed(own))
            continue
        _, k, xhat, inv, gamma, affine = entry
        gx = g * gamma
        if k == downto:
            return gx, xhat
        if affine:
            grads.append(g.sum(axis=0))
            grads.append((g * xhat).sum(axis=0))
        n = known[f"n{k}"]
        g = inv * (gx - known[f"s{k}"] / n - xhat * known[f"t{k}"] / n)
    return grads[::-1]


def with_statistics(samples: DataFrame, layers, params: list[np.ndarray], cfg: TrainConfig, backward: bool = True) -> tuple[DataFrame, list[str], dict]:
    """The samples with their batch's vectors for every batch-norm layer k: m (mean), v (biased variance) and, for the way
    back, n (count), s and t (sums of g and g * xhat); the names of these columns; and the table of statistics of each layer."""
    if cfg.normalize != "samples" or cfg.batch_weights != "uniform":
        raise ValueError("merged batch norm: only normalize='samples' with uniform batch weights")
    spark = samples.sparkSession
    sent = spark.sparkContext.broadcast([np.asarray(p, dtype=np.float64) for p in params])
    norms = [k for k, x in enumerate(layers) if isinstance(x, BatchNorm1d)]
    rows, extra, tables = samples, [], {}
    k_norm = k_norm_of(layers, cfg)

    def saved(df: DataFrame) -> DataFrame:
        path = scratch_path(spark, f"batch-norm-{uuid.uuid4().hex}")
        df.write.parquet(path)
        return spark.read.schema(df.schema).parquet(path)

    def known_of(b, names, at):
        return {c: list_to_matrix(column(b, c))[at] for c in names}

    for k in norms:
        names = list(extra)

        def states(b, k=k, names=names):
            x, _ = _forward(list_to_matrix(column(b, "features")), layers, sent.value, known_of(b, names, slice(None)), k)
            for key, at in _groups(b):
                mean = x[at].mean(axis=0)
                yield key, (len(at), mean, ((x[at] - mean) ** 2).sum(axis=0))

        tables[k] = saved(_by_batch(rows, states, merge_moments))
        new = tables[k].select(*KEYS, F.col("a").alias(f"m{k}"), F.transform("b", lambda x: x / F.col("n")).alias(f"v{k}"), F.array(F.col("n").cast("double")).alias(f"n{k}"))
        rows = rows.join(new, KEYS)
        extra += [f"m{k}", f"v{k}", f"n{k}"]
    for k in reversed(norms) if backward else ():
        names = list(extra)

        def sums(b, k=k, names=names):
            known = known_of(b, names, slice(None))
            out, tape = _forward(list_to_matrix(column(b, "features")), layers, sent.value, known)
            _, g = kernels.loss_and_grad(out, list_to_matrix(column(b, "target")), cfg.loss, cfg.reduction)
            gx, xhat = _backward(tape, g / k_norm, known, k)
            for key, at in _groups(b):
                yield key, (len(at), gx[at].sum(axis=0), (gx[at] * xhat[at]).sum(axis=0))

        own = saved(_by_batch(rows, sums, merge_sums))
        rows = rows.join(own.select(*KEYS, F.col("a").alias(f"s{k}"), F.col("b").alias(f"t{k}")), KEYS)
        extra += [f"s{k}", f"t{k}"]
    return rows, extra, tables


def merged_packets(samples: DataFrame, layers, params: list[np.ndarray], cfg: TrainConfig) -> DataFrame:
    """The gradient packets of ``plans.train``, with batch norm over whole batches wherever their rows lie."""
    rows, extra, tables = with_statistics(samples, layers, params, cfg)

    def gradient(x, y, params, weights, known):
        out, tape = _forward(x, layers, params, known)
        row_loss, g = kernels.loss_and_grad(out, y, cfg.loss, cfg.reduction)
        return _backward(tape, g * weights[:, None], known), row_loss

    out = packets(rows, layers, params, cfg, gradient, tuple(extra))
    handle = out._tablegrad_broadcast
    for k, t in tables.items():
        out = out.unionByName(_running(t, k))
    out._tablegrad_broadcast = handle
    return out


def _running(stats: DataFrame, k: int) -> DataFrame:
    """Sums over batches of the batch means and variances, one row a task, in packet form (kind 2)."""
    def kernel(batches):
        total, n = None, 0
        for b in batches:
            if b.num_rows:
                own = np.concatenate([list_to_matrix(column(b, "a")), list_to_matrix(column(b, "b")) / column(b, "n").to_numpy()[:, None]], axis=1).sum(axis=0)
                total, n = own if total is None else total + own, n + b.num_rows
        if n:
            none = lambda t: pa.nulls(1, t)
            yield pa.RecordBatch.from_arrays([pa.array([2], pa.int32()), pa.array([0], pa.int32()), pa.array([k], pa.int32()), pa.array([total], pa.list_(pa.float64())),
                                              none(pa.int32()), none(pa.int64()), none(pa.float64()), pa.array([n], pa.int64())], names=PACKET_SCHEMA.names)

    return stats.mapInArrow(kernel, PACKET_SCHEMA)


def forward_merged(samples: DataFrame, layers, params: list[np.ndarray], keep=("id",), out_col: str = "out") -> DataFrame:
    """Training-mode outputs of every sample, batch norm over its whole batch."""
    from tablegrad.functions.arrow import matrix_to_list
    rows, extra, _ = with_statistics(samples, layers, params, TrainConfig(loss="mse"), backward=False)
    sent = samples.sparkSession.sparkContext.broadcast([np.asarray(p, dtype=np.float64) for p in params])
    fields = [rows.schema[c] for c in keep]

    def kernel(batches):
        for b in batches:
            if b.num_rows:
                y, _ = _forward(list_to_matrix(column(b, "features")), layers, sent.value, {c: list_to_matrix(column(b, c)) for c in extra})
                yield pa.RecordBatch.from_arrays([*(column(b, c) for c in keep), matrix_to_list(y)], names=[*keep, out_col])

    from pyspark.sql import types as T
    return rows.mapInArrow(kernel, T.StructType([*fields, T.StructField(out_col, T.ArrayType(T.DoubleType()))]))
