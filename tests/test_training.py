"""Gradient kernels against finite differences; equality of execution paths; training makes progress."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tablegrad.functions import columns as C
from tablegrad.functions import kernels
from tablegrad.operators import nn
from tablegrad.plans import train as TR

SF = "/root/testdata/sf0.001"


def _samples(spark, x, y):
    return spark.createDataFrame([(i, x[i].tolist(), y[i].tolist()) for i in range(len(x))],
                                 "row_id bigint, features array<double>, target array<double>")


def _global_loss(x, y, layers, params, cfg, ids):
    """Reference loss in numpy with the same batching (part = id % P, batches of B by id)."""
    k = TR.k_norm_of(layers, cfg)
    total = 0.0
    n = len(x)
    for p in range(cfg.num_partitions):
        idx = [i for i in ids if i % cfg.num_partitions == p]
        for s in range(0, len(idx), cfg.batch_size):
            b = idx[s:s + cfg.batch_size]
            out, _ = kernels.forward(x[b], layers, params, training=True)
            rl, _ = kernels.loss_and_grad(out, y[b], cfg.loss, cfg.reduction)
            total += rl.sum()
    return total / (n * k)


@pytest.mark.parametrize("layers", [
    [nn.Linear(5, 4), nn.Sigmoid(), nn.Linear(4, 3)],
    [nn.Linear(5, 4), nn.BatchNorm1d(4), nn.Sigmoid(), nn.Linear(4, 3)],
])
def test_kernel_gradient_matches_finite_differences(spark, layers):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(37, 5))
    y = np.eye(3)[rng.integers(0, 3, 37)]
    params = nn.init_params_np(layers, seed=3)
    cfg = TR.TrainConfig(loss="cross_entropy", batch_size=8, num_partitions=3)
    s = TR.prepare_samples(_samples(spark, x, y), "row_id", "features", "target", cfg, TR.has_batch_norm(layers))
    g = TR.collect_gradient(TR.packets(s, layers, params, cfg), layers)
    ids = list(range(len(x)))
    h = 1e-6
    for pi, p in enumerate(params):
        for idx in list(np.ndindex(p.shape))[:6]:
            plus = [q.copy() for q in params]
            minus = [q.copy() for q in params]
            plus[pi][idx] += h
            minus[pi][idx] -= h
            fd = (_global_loss(x, y, layers, plus, cfg, ids) - _global_loss(x, y, layers, minus, cfg, ids)) / (2 * h)
            assert abs(fd - g[pi][idx]) < 1e-6, (pi, idx, fd, g[pi][idx])


def test_partition_count_and_barrier_do_not_change_gradient(spark):
    from tablegrad.plans.catalog_train import MLP_LAYERS, emb_samples, mlp_params
    out = []
    for parts, barrier in ((1, False), (4, False), (4, True)):
        cfg = TR.TrainConfig(batch_size=32, num_partitions=parts, barrier=barrier)
        s = TR.prepare_samples(emb_samples(spark, SF), "row_id", "features", "target", cfg)
        out.append(np.concatenate([g.ravel() for g in TR.collect_gradient(
            TR.packets(s, MLP_LAYERS, mlp_params(), cfg), MLP_LAYERS)]))
    assert np.allclose(out[0], out[1], atol=1e-12) and np.allclose(out[1], out[2], atol=1e-12)


def test_relational_gradient_equals_kernel(spark):
    from tablegrad.plans.catalog_train import LIN_LAYERS, emb_samples, lin_params, linear_ce_grad_cells
    cfg = TR.TrainConfig(batch_size=32, num_partitions=4)
    s = TR.prepare_samples(emb_samples(spark, SF), "row_id", "features", "target", cfg)
    k = TR.collect_gradient(TR.packets(s, LIN_LAYERS, lin_params(), cfg), LIN_LAYERS)
    rel = {(r.param_id, r.pos): r.grad for r in linear_ce_grad_cells(spark, SF).collect()}
    assert max(abs(rel[(0, p)] - v) for p, v in enumerate(k[0].ravel())) < 1e-12
    assert max(abs(rel[(1, p)] - v) for p, v in enumerate(k[1].ravel())) < 1e-12


def test_reference_normalisation_and_prefix_weights(spark):
    rng = np.random.default_rng(1)
    x, y = rng.normal(size=(20, 3)), rng.normal(size=(20, 1))
    layers = [nn.Linear(3, 1)]
    params = nn.init_params_np(layers, 5)
    base = dict(loss="mse", batch_size=4, num_partitions=2)
    grads = {}
    for norm, bw in (("reference", "uniform"), ("reference", "prefix")):
        cfg = TR.TrainConfig(normalize=norm, batch_weights=bw, **base)
        s = TR.prepare_samples(_samples(spark, x, y), "row_id", "features", "target", cfg)
        grads[bw] = TR.collect_gradient(TR.packets(s, layers, params, cfg), layers)
    # numpy: per partition, batch means of the gradient, prefix weight K - b
    exp = {"uniform": [np.zeros((3, 1)), np.zeros(1)], "prefix": [np.zeros((3, 1)), np.zeros(1)]}
    for p in range(2):
        idx = [i for i in range(20) if i % 2 == p]
        batches = [idx[s:s + 4] for s in range(0, len(idx), 4)]
        for b_i, b in enumerate(batches):
            err = x[b] @ params[0] + params[1] - y[b]
            gw, gb = x[b].T @ (2 * err) / len(b), (2 * err).sum(axis=0) / len(b)
            for key, wgt in (("uniform", 1.0), ("prefix", float(len(batches) - b_i))):
                exp[key][0] += wgt * gw / 20
                exp[key][1] += wgt * gb / 20
    for key in exp:
        assert np.allclose(grads[key][0], exp[key][0]) and np.allclose(grads[key][1], exp[key][1])


def test_training_reduces_loss(spark):
    from tablegrad.plans.catalog_train import train_mlp_history
    h = train_mlp_history(spark, SF, epochs=4).groupBy("epoch").agg(F.avg("avg_batch_loss").alias("l")).orderBy("epoch")
    losses = [r.l for r in h.collect()]
    assert len(losses) == 4 and losses[-1] < losses[0]


def test_regression_with_batch_norm_runs(spark):
    """The reference's 1-3-1 regression set with batch norm: x = 0..199, y = x^2 + 1, batch 20, SGD."""
    x = np.arange(200, dtype=float).reshape(-1, 1) / 200.0
    y = (np.arange(200, dtype=float) ** 2 + 1).reshape(-1, 1) / 40000.0
    layers = [nn.Linear(1, 3), nn.BatchNorm1d(3), nn.ReLU(), nn.Linear(3, 1)]
    cfg = TR.TrainConfig(loss="mse", batch_size=20, num_partitions=1, epochs=5, lr=0.1)
    params, hist = TR.train(spark, _samples(spark, x, y), "row_id", "features", "target", layers,
                            nn.init_params_np(layers, 2), cfg)
    assert hist.count() == 5 and all(np.isfinite(p).all() for p in params)


def test_optimizers_table_equals_driver(spark):
    from tablegrad.operators import optim
    params = [np.array([[0.5, -0.2], [0.1, 0.3]]), np.array([0.0, 1.0])]
    g = [np.array([[0.1, 0.2], [-0.3, 0.4]]), np.array([0.5, -0.5])]
    layers = [nn.Linear(2, 2)]
    pt = nn.params_to_table(spark, layers, params)
    gt = nn.params_to_table(spark, layers, g).withColumnRenamed("value", "grad")
    a = optim.Adam(lr=0.01)
    drv = a.step(a.step(params, g), g)
    tab = optim.adam_step(optim.adam_step(pt, gt, 1, lr=0.01), gt, 2, lr=0.01)
    got = nn.table_to_params(tab, layers)
    assert all(np.allclose(x, y, atol=1e-12) for x, y in zip(drv, got))
    sg = nn.table_to_params(optim.sgd_step(pt, gt, 0.1), layers)
    assert all(np.allclose(x, y) for x, y in zip(optim.SGD(0.1).step(params, g), sg))


def test_running_stats_closed_form_equals_fold(spark):
    rng = np.random.default_rng(4)
    means, vars_ = rng.normal(size=7), rng.uniform(0.5, 2, size=7)
    df = spark.createDataFrame([(b, 0, float(means[b]), float(vars_[b])) for b in range(7)],
                               "b long, j int, mean double, var double")
    r = nn.running_stats(df, "b", ["j"], momentum=0.1).first()
    rm, rv = 0.0, 1.0
    for b in range(7):
        rm = 0.9 * rm + 0.1 * means[b]
        rv = 0.9 * rv + 0.1 * vars_[b]
    assert abs(r.running_mean - rm) < 1e-12 and abs(r.running_var - rv) < 1e-12


def test_table_resident_steps_cut_lineage(spark):
    """Iterated table optimizer steps equal the driver loop; checkpoints keep the plan short."""
    from tablegrad.operators import optim
    rng = np.random.default_rng(9)
    x = rng.normal(size=(30, 2))
    y = x @ np.array([[0.5], [-1.0]]) + 0.25
    layers = [nn.Linear(2, 1)]
    p0 = [np.zeros((2, 1)), np.zeros(1)]
    data = spark.createDataFrame([(x[i].tolist(), y[i].tolist()) for i in range(30)],
                                 "features array<double>, target array<double>")

    def grad_fn(ptab):
        w, b = nn.table_to_params(ptab, layers)
        from tablegrad.operators import grads as G
        rows = data.select("features", G.grad_mse(C.vec_matmul("features", w, b), "target", 1.0).alias("dz"))
        return G.linear_param_grads(rows, "features", "dz", w, mean=True)

    out = optim.iterate_table_steps(nn.params_to_table(spark, layers, p0), grad_fn, steps=6, lr=0.1,
                                    checkpoint_every=3)
    got = nn.table_to_params(out, layers)
    w, b = p0
    for _ in range(6):
        err = x @ w + b - y
        w, b = w - 0.1 * x.T @ (2 * err) / 30, b - 0.1 * (2 * err).sum(axis=0) / 30
    assert np.allclose(got[0], w) and np.allclose(got[1], b)
