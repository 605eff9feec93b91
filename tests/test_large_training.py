"""Merged batch norm, parameter blocks and local training against numpy and finite differences."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tablegrad.functions import kernels
from tablegrad.operators import nn, optim
from tablegrad.plans import train as TR
from tablegrad.plans import train_blocks as TB
from tablegrad.plans import train_bn as BN
from tablegrad.plans import train_local as TL

RNG = np.random.default_rng(4)
X, Y = RNG.normal(size=(61, 5)) * 2 + 1, np.eye(3)[RNG.integers(0, 3, 61)]


def samples(spark, x=X, y=Y, parts=5):
    return spark.createDataFrame([(i * 3, x[i].tolist(), y[i].tolist()) for i in range(len(x))],
                                 "row_id bigint, features array<double>, target array<double>").repartition(parts)


def batches_of(n, parts, size):
    """Rows of each mini-batch: part = id % P, ids 0, 3, 6..., batches of ``size`` by id."""
    for p in range(parts):
        own = [i for i in range(n) if (3 * i) % parts == p]
        yield from ((p, own[s:s + size]) for s in range(0, len(own), size))


def loss(x, y, layers, params, cfg):
    total = 0.0
    for _, b in batches_of(len(x), cfg.num_partitions, cfg.batch_size):
        out, _ = kernels.forward(x[b], layers, params, training=True)
        total += kernels.loss_and_grad(out, y[b], cfg.loss, cfg.reduction)[0].sum()
    return total / (len(x) * TR.k_norm_of(layers, cfg))


TWO_NORMS = [nn.BatchNorm1d(5), nn.Linear(5, 4), nn.BatchNorm1d(4), nn.Sigmoid(), nn.Linear(4, 3), nn.BatchNorm1d(3, affine=False)]


@pytest.mark.parametrize("parts,size", [(1, 1000), (2, 16)])
@pytest.mark.parametrize("loss_name", ["cross_entropy", "mse"])
def test_merged_batch_norm_gradient(spark, parts, size, loss_name):
    """Rows of a batch lie in five tasks; the gradient is that of whole batches."""
    cfg = TR.TrainConfig(loss=loss_name, batch_size=size, num_partitions=parts)
    params = nn.init_params_np(TWO_NORMS, seed=3)
    s = TR.prepare_samples(samples(spark), "row_id", "features", "target", cfg)
    g = TR.collect_gradient(BN.merged_packets(s, TWO_NORMS, params, cfg), TWO_NORMS)
    h = 1e-6
    for k, p in enumerate(params):
        for i in list(np.ndindex(p.shape))[:5]:
            up, down = [q.copy() for q in params], [q.copy() for q in params]
            up[k][i] += h
            down[k][i] -= h
            fd = (loss(X, Y, TWO_NORMS, up, cfg) - loss(X, Y, TWO_NORMS, down, cfg)) / (2 * h)
            assert abs(fd - g[k][i]) < 1e-6, (k, i)
    out = {r.id // 3: r.out for r in BN.forward_merged(s, TWO_NORMS, params).collect()}
    for _, b in batches_of(len(X), parts, size):
        assert np.allclose([out[i] for i in b], kernels.forward(X[b], TWO_NORMS, params)[0])


def test_merged_and_gathered_training_agree(spark):
    layers = [nn.Linear(5, 4), nn.BatchNorm1d(4), nn.ReLU(), nn.Linear(4, 3)]
    ends = []
    for mode in ("gathered", "merged"):
        cfg = TR.TrainConfig(epochs=2, lr=0.3, batch_size=8, num_partitions=2, batch_norm=mode)
        ends.append(TR.train_with_buffers(spark, samples(spark), "row_id", "features", "target", layers, nn.init_params_np(layers, 1), cfg))
    for a, b in zip(ends[0][0], ends[1][0]):
        assert np.allclose(a, b, atol=1e-12)
    assert all(np.allclose(x, y) for x, y in zip(ends[0][1][1], ends[1][1][1]))
    key = lambda r: (r.epoch, r.part)
    h = [[(r.n, r.batches, round(r.avg_batch_loss, 12)) for r in sorted(e[2].collect(), key=key)] for e in ends]
    assert h[0] == h[1]
    with pytest.raises(ValueError, match="mode"):
        TR.train(spark, samples(spark), "row_id", "features", "target", layers, nn.init_params_np(layers, 1), TR.TrainConfig(batch_norm="x"))
    with pytest.raises(ValueError, match="normalize"):
        TR.train(spark, samples(spark), "row_id", "features", "target", layers, nn.init_params_np(layers, 1), TR.TrainConfig(batch_norm="merged", normalize="reference"))


def test_moments_merge_without_cancellation():
    x = RNG.normal(size=(400, 2)) + 1e8
    state = None
    for part in np.array_split(x, 7):
        own = (len(part), part.mean(axis=0), ((part - part.mean(axis=0)) ** 2).sum(axis=0))
        state = own if state is None else BN.merge_moments(*state, *own)
    assert state[0] == 400 and np.allclose(state[2] / 400, x.var(axis=0), rtol=1e-6)


# --- parameter blocks

@pytest.mark.parametrize("optimizer", ["sgd", "adam"])
@pytest.mark.parametrize("loss_name", ["cross_entropy", "mse"])
def test_blocks_train_as_one_model_does(spark, optimizer, loss_name):
    layers = [nn.Linear(5, 7), nn.Sigmoid(), nn.Linear(7, 6, bias=False), nn.ReLU(), nn.Linear(6, 3)]
    params = nn.init_params_np(layers, seed=9)
    cfg = TB.BlockConfig(loss=loss_name, optimizer=optimizer, steps=3, lr=0.1, size=4)
    got, losses = TB.train_blocks(spark, samples(spark), "row_id", "features", "target", layers, nn.params_to_table(spark, layers, params), cfg)
    opt = optim.SGD(0.1) if optimizer == "sgd" else optim.Adam(0.1)
    want, want_losses = params, []
    for _ in range(3):
        g, row = kernels.batch_gradient(X, Y, layers, want, loss_name, np.full(len(X), 1 / (3 * len(X))))
        want_losses.append(row.sum() / (3 * len(X)))
        want = opt.step(want, g)
    for a, b in zip(nn.table_to_params(got, layers), want):
        assert np.allclose(a, b, atol=1e-10)
    assert np.allclose(losses, want_losses)


def test_blocks_refuse_what_they_cannot_do(spark):
    layers = [nn.Linear(5, 3)]
    table = nn.params_to_table(spark, layers, nn.init_params_np(layers, 1))
    run = lambda layers, table, **o: TB.train_blocks(spark, samples(spark), "row_id", "features", "target", layers, table, TB.BlockConfig(**o))[0].collect()
    with pytest.raises(Exception, match="missing"):
        run(layers, table.where("NOT (param_id = 0 AND pos = 4)"), size=4)
    with pytest.raises(ValueError, match="wide"):
        run(layers, table, size=2)
    with pytest.raises(ValueError, match="tiled"):
        run([nn.Linear(5, 3), nn.BatchNorm1d(3)], table, size=4)
    with pytest.raises(ValueError, match="optimizer"):
        run(layers, table, size=4, optimizer="x")
    assert TB.train_blocks(spark, samples(spark).limit(0), "row_id", "features", "target", layers, table, TB.BlockConfig())[1] == []


# --- local training

@pytest.mark.parametrize("steps", [None, 1, 2])
@pytest.mark.parametrize("layers", [[nn.Linear(5, 3)], [nn.Linear(5, 4), nn.BatchNorm1d(4), nn.Linear(4, 3)]])
def test_local_steps_then_averages(spark, steps, layers):
    cfg = TR.TrainConfig(lr=0.4, epochs=2, batch_size=7, num_partitions=4)
    params = nn.init_params_np(layers, 2)
    run = lambda: TL.train_local(spark, samples(spark), "row_id", "features", "target", layers, params, cfg, steps)
    if steps is not None and len(layers) > 1:
        with pytest.raises(ValueError, match="each batch"):
            run()
        return
    want = params
    for _ in range(2):
        total, n = [np.zeros_like(p) for p in params], 0
        for part in range(4):
            own, rows = [p.copy() for p in want], 0
            mine = [b for p, b in batches_of(len(X), 4, 7) if p == part]
            for group in ([sum(mine[s::steps], []) for s in range(steps)] if steps else mine):
                if group:
                    g, _ = kernels.batch_gradient(X[group], Y[group], layers, own, "cross_entropy", np.full(len(group), 1 / (3 * len(group))))
                    own = optim.SGD(0.4).step(own, g)
                    rows += len(group)
            total, n = [t + rows * p for t, p in zip(total, own)], n + rows
        want = [t / n for t in total]
    for a, b in zip(run(), want):
        assert np.allclose(a, b, atol=1e-12)


def test_local_training_keeps_optimizer_state_in_a_part(spark):
    layers, cfg = [nn.Linear(5, 3)], TR.TrainConfig(optimizer="adam", lr=0.1, epochs=1, batch_size=20, num_partitions=1)
    params = nn.init_params_np(layers, 2)
    got = TL.train_local(spark, samples(spark), "row_id", "features", "target", layers, params, cfg)
    want, opt = params, optim.Adam(0.1)
    for _, b in batches_of(len(X), 1, 20):
        want = opt.step(want, kernels.batch_gradient(X[b], Y[b], layers, want, "cross_entropy", np.full(len(b), 1 / (3 * len(b))))[0])
    assert all(np.allclose(a, b) for a, b in zip(got, want))
    assert TL.train_local(spark, samples(spark).limit(0), "row_id", "features", "target", layers, params, cfg) is not None
