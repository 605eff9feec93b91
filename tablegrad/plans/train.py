"""Synchronous data-parallel training as Spark jobs.

Per epoch:

1. parameters (model-sized) are broadcast;
2. ``mapInArrow`` runs the numpy forward/backward over each task's rows, Arrow batch by Arrow batch (mini-batch
   by mini-batch when the model has batch norm), and emits one gradient *packet* per task, cut into fixed-size
   blocks, plus per-(part, batch) loss sums;
3. packets are summed in two levels -- ``groupBy(bucket, block)`` then ``groupBy(block)`` with
   ``bucket = task % ceil(sqrt(tasks))`` -- so no reducer receives more than ~sqrt(tasks) packets per block;
4. the summed gradient (model-sized) is collected and one optimizer step runs on the driver.

The sample table is prepared once (partition + batch columns, one shuffle) and written to the shared folder; every step
reads it. An epoch makes ``steps_per_epoch`` such steps, each over its share of the batches.
Losses follow ``normalize``: ``'samples'`` gives the gradient of the mean loss over all samples,
``'reference'`` sums per-batch mean gradients and divides by the sample count. ``batch_weights='prefix'``
weighs batch b of K by K - b (the accumulate-without-reset behaviour), ``'uniform'`` by 1.
"""

from __future__ import annotations

import math
import time
import uuid
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablegrad.functions import kernels
from tablegrad.functions.arrow import column, list_to_matrix
from tablegrad.operators import batching
from tablegrad.operators.nn import BatchNorm1d, param_specs
from tablegrad.operators.optim import SGD, Adam, clip_np
from tablegrad.session import scratch_path

BLOCK = 4096  # doubles per gradient block row

PACKET_SCHEMA = T.StructType([
    T.StructField("kind", T.IntegerType()),
    T.StructField("bucket", T.IntegerType()),
    T.StructField("block", T.IntegerType()),
    T.StructField("grad", T.ArrayType(T.DoubleType())),
    T.StructField("part", T.IntegerType()),
    T.StructField("batch_id", T.LongType()),
    T.StructField("loss_sum", T.DoubleType()),
    T.StructField("n", T.LongType()),
])


@dataclass
class TrainConfig:
    loss: object = "cross_entropy"       # 'cross_entropy' | 'mse' | a function (out, target) -> (row losses, gradient)
    reduction: str = "elements"          # cross entropy: 'elements' (rows x classes) | 'batch' (rows)
    normalize: str = "samples"           # 'samples' | 'reference'
    batch_weights: str = "uniform"       # 'uniform' | 'prefix'
    batch_size: int = 64
    num_partitions: int = 4
    epochs: int = 1
    optimizer: object = "sgd"            # 'sgd' | 'adam' | an object with step(params, grads)
    steps_per_epoch: int = 1             # global steps: step s of S takes the batches with batch_id % S = s
    lr: float = 0.01
    clip: float | None = None
    barrier: bool = False
    batch_norm: str = "gathered"         # 'gathered': a mini-batch meets in one task | 'merged': its statistics do (train_bn)
    adam: dict = field(default_factory=dict)


def prepare_samples(df: DataFrame, id_col: str, features: str, target: str, cfg: TrainConfig,
                    whole_batches: bool = False, batched: bool = True) -> DataFrame:
    """Sample table with part / batch columns.

    ``batched=False`` is enough for a gradient that doesn't depend on batches: no rank, no sort. Without batch norm
    rows stay in their rank slices. With batch norm every mini-batch must sit whole in one task: rows are
    hash-partitioned by (part, batch_id) -- groups of at most B rows -- and sorted so each batch is contiguous.
    """
    x = df.select(id_col, features, target)
    if batched or whole_batches or cfg.batch_weights == "prefix" or cfg.normalize != "samples":
        b = batching.assign_batches(x, id_col, cfg.num_partitions, cfg.batch_size)
    else:
        zero = F.lit(0).cast("bigint")
        b = batching.assign_partition(x, id_col, cfg.num_partitions).withColumns({"batch_id": zero, "bsize": F.lit(1), "nbatches": zero + 1})
    out = b.select(F.col(id_col).alias("id"), F.col(features).alias("features"), F.col(target).alias("target"),
                   "part", "batch_id", "bsize", "nbatches")
    n = int(out.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    if cfg.barrier:
        # a barrier stage needs one free slot per task and a plain shuffle boundary below it (no coalesce)
        n = min(n, out.sparkSession.sparkContext.defaultParallelism)
    if whole_batches:
        out = out.repartition(n, "part", "batch_id").sortWithinPartitions("part", "batch_id", "id")
    elif cfg.barrier:
        out = out.repartition(n, "id")
    return out


def has_batch_norm(layers) -> bool:
    return any(isinstance(layer, BatchNorm1d) for layer in layers)


def _out_width(layers) -> int:
    for layer in reversed(layers):
        if hasattr(layer, "out_features"):
            return layer.out_features
        if isinstance(layer, BatchNorm1d):
            return layer.num_features
        if getattr(layer, "width", None):
            return layer.width
    raise ValueError("model has no sized layer")


def _packet_kernel(bc, layers, cfg: TrainConfig, n_buckets: int, gradient=None, extra: tuple = ()):
    """``gradient(x, y, params, weights, known) -> (gradients, row losses)`` replaces the usual backward pass; ``known`` has the
    matrices of the ``extra`` array columns of the same rows."""
    k_norm = k_norm_of(layers, cfg)
    has_bn = has_batch_norm(layers) and gradient is None

    def weights_for(bsize, nb, batch_id):
        if cfg.normalize == "samples":
            w = np.full(len(bsize), 1.0 / k_norm)
        else:
            w = 1.0 / (bsize.astype(np.float64) * k_norm)
        if cfg.batch_weights == "prefix":
            w = w * (nb - batch_id).astype(np.float64)
        return w

    def kernel(batches):
        from pyspark import BarrierTaskContext, TaskContext
        ctx = TaskContext.get()
        pid = ctx.partitionId() if ctx is not None else 0
        params = bc.value
        acc = [np.zeros_like(p) for p in params]
        loss_rows: dict[tuple[int, int], list] = {}
        stats: dict[int, list] = {}  # batch-norm layer -> [sum of batch means, sum of batch variances, batches]
        seen = 0

        def run(x, y, part, bid, bsize, nb, **known):
            nonlocal seen
            seen += len(x)
            w = weights_for(bsize, nb, bid)
            if gradient is not None:
                grads, row_loss = gradient(x, y, params, w, known)
            else:
                grads, row_loss = kernels.batch_gradient(x, y, layers, params, cfg.loss, w, cfg.reduction, stats=stats)
            for a, g in zip(acc, grads):
                a += g
            uk, inv = np.unique(np.stack([part.astype(np.int64), bid.astype(np.int64)], 1), axis=0, return_inverse=True)
            sums = np.bincount(inv.ravel(), weights=row_loss)
            cnts = np.bincount(inv.ravel())
            for key, s, c in zip(uk.tolist(), sums, cnts):
                r = loss_rows.setdefault(tuple(key), [0.0, 0])
                r[0] += float(s)
                r[1] += int(c)

        pending = None
        for batch in batches:
            if batch.num_rows == 0:
                continue
            cols = dict(x=list_to_matrix(column(batch, "features")), y=list_to_matrix(column(batch, "target")),
                        part=column(batch, "part").to_numpy(), bid=column(batch, "batch_id").to_numpy(),
                        bsize=column(batch, "bsize").to_numpy(), nb=column(batch, "nbatches").to_numpy())
            if not has_bn:
                run(**cols, **{c: list_to_matrix(column(batch, c)) for c in extra})
                continue
            # batch norm needs whole mini-batches: rows arrive ordered by (part, id), so batches are contiguous
            if pending is not None:
                cols = {k: np.concatenate([pending[k], v]) for k, v in cols.items()}
            last = np.nonzero((cols["part"] != cols["part"][-1]) | (cols["bid"] != cols["bid"][-1]))[0]
            cut = int(last[-1]) + 1 if len(last) else 0
            done = {k: v[:cut] for k, v in cols.items()}
            pending = {k: v[cut:] for k, v in cols.items()}
            _run_groups(run, done)
        if has_bn and pending is not None and len(pending["x"]):
            _run_groups(run, pending)

        if cfg.barrier:
            BarrierTaskContext.get().barrier()
        flat = np.concatenate([a.ravel() for a in acc]) if acc else np.zeros(0)
        rows = [(0, i, flat[i * BLOCK:(i + 1) * BLOCK], None, None, None, seen) for i in range(max(1, math.ceil(len(flat) / BLOCK)))]
        rows += [(1, None, None, part, bid, s, n) for (part, bid), (s, n) in loss_rows.items()]
        rows += [(2, k, np.concatenate([m, v]), None, None, None, n) for k, (m, v, n) in stats.items()]
        kind, block, grad, part, bid, loss, n = zip(*rows)
        yield pa.RecordBatch.from_arrays([
            pa.array(kind, pa.int32()), pa.array([pid % n_buckets] * len(rows), pa.int32()), pa.array(block, pa.int32()),
            pa.array(grad, pa.list_(pa.float64())), pa.array(part, pa.int32()), pa.array(bid, pa.int64()),
            pa.array(loss, pa.float64()), pa.array(n, pa.int64())], names=[f.name for f in PACKET_SCHEMA.fields])

    return kernel


def _run_groups(run, cols):
    if not len(cols["x"]):
        return
    bounds = np.nonzero((np.diff(cols["part"]) != 0) | (np.diff(cols["bid"]) != 0))[0] + 1
    for s, e in zip(np.r_[0, bounds], np.r_[bounds, len(cols["x"])]):
        run(**{k: v[s:e] for k, v in cols.items()})


def array_sum_agg(c: str):
    """Elementwise sum of the arrays in a group (groups are bounded by the bucket fan-in)."""
    lst = F.collect_list(c)
    zero = F.transform(F.element_at(lst, 1), lambda x: F.lit(0.0))
    return F.aggregate(lst, zero, lambda acc, x: F.zip_with(acc, x, lambda a, b: a + b))


def packets(samples: DataFrame, layers, params: list[np.ndarray], cfg: TrainConfig, gradient=None, extra: tuple = ()) -> DataFrame:
    spark = samples.sparkSession
    if isinstance(cfg.loss, str) and cfg.loss not in ("cross_entropy", "mse"):
        raise ValueError(f"unknown loss {cfg.loss}")
    bc = spark.sparkContext.broadcast([np.asarray(p, dtype=np.float64) for p in params])
    n_buckets = max(1, math.ceil(math.sqrt(int(spark.conf.get("spark.sql.shuffle.partitions")))))
    kernel = _packet_kernel(bc, layers, cfg, n_buckets, gradient, extra)
    out = samples.mapInArrow(kernel, PACKET_SCHEMA, barrier=cfg.barrier)
    out._tablegrad_broadcast = bc  # keep a handle so the caller can unpersist it
    return out


def summed_gradient(pk: DataFrame) -> DataFrame:
    """Two-level sum of the gradient blocks, divided by the samples counted in the same pass -> (block, grad)."""
    g = pk.where(F.col("kind") == 0)
    lvl1 = g.groupBy("bucket", "block").agg(array_sum_agg("grad").alias("grad"), F.sum("n").alias("n"))
    both = lvl1.groupBy("block").agg(array_sum_agg("grad").alias("grad"), F.sum("n").alias("n"))
    return both.select("block", F.transform("grad", lambda x: x / F.greatest(F.col("n"), F.lit(1))).alias("grad"))


def batch_norm_stats(pk: DataFrame) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Mean over batches of the batch means and variances of each batch-norm layer (model-sized)."""
    s = pk.where(F.col("kind") == 2).groupBy("block").agg(array_sum_agg("grad").alias("grad"), F.sum("n").alias("n")).collect()
    out = {}
    for r in s:
        v = np.asarray(r["grad"]) / r["n"]
        out[int(r["block"])] = (v[:len(v) // 2], v[len(v) // 2:])
    return out


def gradient_cells(pk: DataFrame, layers) -> DataFrame:
    """Summed gradient as layout P cells ``(param_id, name, pos, grad)`` (lazy; no driver pull)."""
    specs = param_specs(layers)
    sizes = [int(np.prod(s)) for _, s in specs]
    offs = np.r_[0, np.cumsum(sizes)].astype(np.int64)
    ex = summed_gradient(pk).select(F.posexplode("grad").alias("_i", "grad"), "block").select(
        (F.col("block").cast("bigint") * BLOCK + F.col("_i")).alias("_flat"), "grad")
    pid = sum((F.col("_flat") >= int(o)).cast("int") for o in offs[1:-1]) if len(offs) > 2 else F.lit(0)
    ex = ex.withColumn("param_id", pid.cast("int") if not isinstance(pid, int) else F.lit(0))
    names = F.array(*[F.lit(n) for n, _ in specs])
    starts = F.array(*[F.lit(int(o)) for o in offs[:-1]])
    return ex.select("param_id", F.element_at(names, F.col("param_id") + 1).alias("name"),
                     (F.col("_flat") - F.element_at(starts, F.col("param_id") + 1)).alias("pos"), "grad")


def partition_losses(pk: DataFrame, k_norm: int) -> DataFrame:
    """Per part: batches, samples, average over batches of the batch-mean loss (denominator at least 1)."""
    per_batch = (pk.where(F.col("kind") == 1).groupBy("part", "batch_id")
                 .agg(F.sum("loss_sum").alias("ls"), F.sum("n").alias("n")))
    return per_batch.groupBy("part").agg(
        F.count("*").cast("int").alias("batches"), F.sum("n").alias("n"),
        (F.sum(F.col("ls") / (F.col("n") * F.lit(k_norm))) / F.greatest(F.count("*"), F.lit(1))).alias(
            "avg_batch_loss"))


def collect_gradient(pk: DataFrame, layers) -> list[np.ndarray]:
    specs = param_specs(layers)
    total = sum(int(np.prod(s)) for _, s in specs)
    flat = np.zeros(total)
    got = summed_gradient(pk).orderBy("block").toArrow()
    if got.num_rows:
        flat[:] = got["grad"].combine_chunks().flatten().to_numpy()
    out, o = [], 0
    for _, shape in specs:
        n = int(np.prod(shape))
        out.append(flat[o:o + n].reshape(shape))
        o += n
    return out


HISTORY_SCHEMA = T.StructType([
    T.StructField("epoch", T.IntegerType()), T.StructField("part", T.IntegerType()),
    T.StructField("batches", T.IntegerType()), T.StructField("n", T.LongType()),
    T.StructField("avg_batch_loss", T.DoubleType()), T.StructField("epoch_ms", T.LongType())])


def k_norm_of(layers, cfg: TrainConfig) -> int:
    return _out_width(layers) if (cfg.loss == "mse" or callable(cfg.loss) or cfg.reduction == "elements") else 1


def make_optimizer(cfg: TrainConfig):
    """The named optimizer, or the user's own object."""
    if hasattr(cfg.optimizer, "step"):
        return cfg.optimizer
    if cfg.optimizer == "sgd":
        return SGD(cfg.lr)
    if cfg.optimizer == "adam":
        return Adam(lr=cfg.lr, **cfg.adam)
    raise ValueError(f"unknown optimizer {cfg.optimizer}")


def train(spark: SparkSession, df: DataFrame, id_col: str, features: str, target: str, layers,
          params: list[np.ndarray], cfg: TrainConfig):
    """Returns (final parameters, history DataFrame); ``cfg.steps_per_epoch`` global optimizer steps per epoch."""
    params, _, hist = train_with_buffers(spark, df, id_col, features, target, layers, params, cfg)
    return params, hist


def train_with_buffers(spark: SparkSession, df: DataFrame, id_col: str, features: str, target: str, layers,
                       params: list[np.ndarray], cfg: TrainConfig, buffers: dict | None = None):
    """(parameters, batch-norm buffers, history). ``buffers``: layer -> (running mean, running variance).

    Each global step moves the running statistics by the layer's momentum towards the mean of its batch statistics.
    """
    opt = make_optimizer(cfg)
    if cfg.batch_norm not in ("gathered", "merged"):
        raise ValueError(f"unknown batch norm mode {cfg.batch_norm}")
    merged = has_batch_norm(layers) and cfg.batch_norm == "merged"
    gathered = has_batch_norm(layers) and not merged
    samples = prepare_samples(df, id_col, features, target, cfg, gathered)
    path = scratch_path(spark, f"samples-{uuid.uuid4().hex}")
    samples.write.parquet(path)  # every step reads this table; nothing is cached on executors
    samples = spark.read.schema(samples.schema).parquet(path)
    if gathered:
        n = int(spark.conf.get("spark.sql.shuffle.partitions"))
        samples = samples.repartition(n, "part", "batch_id").sortWithinPartitions("part", "batch_id", "id")
    k_norm = k_norm_of(layers, cfg)
    buffers = dict(buffers or {k: (np.zeros(x.num_features), np.ones(x.num_features)) for k, x in enumerate(layers) if isinstance(x, BatchNorm1d)})
    hist = []
    params = [np.asarray(p, dtype=np.float64) for p in params]
    for epoch in range(cfg.epochs):
        for step in range(cfg.steps_per_epoch):
            t0 = time.time()
            own = samples.where(F.col("batch_id") % cfg.steps_per_epoch == step) if cfg.steps_per_epoch > 1 else samples
            pk_path = scratch_path(spark, f"packets-{uuid.uuid4().hex}")
            if merged:
                from tablegrad.plans.train_bn import merged_packets
                pk = merged_packets(own, layers, params, cfg)
            else:
                pk = packets(own, layers, params, cfg)
            pk.write.parquet(pk_path)
            pk._tablegrad_broadcast.unpersist(blocking=True)
            pk = spark.read.schema(PACKET_SCHEMA).parquet(pk_path)
            grads = collect_gradient(pk, layers)
            losses = partition_losses(pk, k_norm).collect()
            for k, (m, v) in batch_norm_stats(pk).items() if buffers else ():
                a = layers[k].momentum
                buffers[k] = ((1 - a) * buffers[k][0] + a * m, (1 - a) * buffers[k][1] + a * v)
            if cfg.clip is not None:
                grads = clip_np(grads, cfg.clip)
            params = opt.step(params, grads)
            ms = int((time.time() - t0) * 1000)
            hist.extend((epoch + 1, int(r["part"]), int(r["batches"]), int(r["n"]), float(r["avg_batch_loss"]), ms)
                        for r in losses)
    return params, buffers, spark.createDataFrame(hist, HISTORY_SCHEMA)


def buffer_table(spark: SparkSession, buffers: dict) -> DataFrame:
    """Batch-norm buffers as ``(layer, j, running_mean, running_var)``."""
    rows = [(int(k), j, float(m), float(v)) for k, (ms, vs) in buffers.items() for j, (m, v) in enumerate(zip(ms, vs))]
    return spark.createDataFrame(rows, "layer int, j int, running_mean double, running_var double")
