"""Shapes that don't fit, unknown names, user-defined parts and model files."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tablegrad.operators import collectives, elementwise, layout, linalg, nn, optim
from tablegrad.plans import train as TR
from tablegrad.plans.catalog_more import tanh_scale
from conftest import rows


def fails(df):
    with pytest.raises(Exception):
        df.collect()


def cells(spark, data, names):
    return spark.createDataFrame(data, ", ".join(f"{n} bigint" for n in names) + ", v double")


def test_take_rows_out_of_range(spark):
    r = rows(spark, [[1, 2], [3, 4]])
    assert layout.take_rows(r, spark.createDataFrame([(0, 1), (1, 1)], "out_row bigint, src_row bigint")).count() == 2
    beyond = layout.take_rows(r, spark.createDataFrame([(0, 1), (1, 2)], "out_row bigint, src_row bigint"))
    for df in (beyond, beyond.select("vec"), beyond.select("row_id"), beyond.agg(F.count("*"))):
        fails(df)
    with pytest.raises(Exception):
        beyond.count()


def test_stack_rows_checks_shapes(spark):
    a = rows(spark, [[1, 2], [3, 4]])
    assert layout.stack_rows([a, a], 2, 2).count() == 4
    for bad in (rows(spark, [[1, 2], [3, 4, 5]]), a.withColumn("row_id", F.col("row_id") + 1)):
        whole = layout.stack_rows([a, bad], 2, 2)
        for df in (whole, whole.select("row_id"), whole.select("vec"), whole.select("rank"), whole.agg(F.count("*"))):
            fails(df)
    fails(layout.stack_rows([a, rows(spark, [[1], [2]])], 2, 2))
    fails(layout.stack_rows([a, a], 1, 2))


def test_a_missing_cell_fails_the_product(spark):
    b = cells(spark, [(0, 0, 1.0), (1, 0, 1.0)], ["k", "j"])
    whole = [(0, 0, 1.0), (0, 1, 5.0), (1, 0, 2.0), (1, 1, 3.0)]
    assert sorted(r.v for r in linalg.cells_matmul(cells(spark, whole, ["i", "k"]), b).collect()) == [5.0, 6.0]
    for bad in (whole[:1] + whole[2:], [*whole, (1, 1, 3.0)]):
        for size in (None, 2):
            fails(linalg.cells_matmul(cells(spark, bad, ["i", "k"]), b, size=size))


def test_broadcast_and_cell_shapes(spark):
    a = rows(spark, [[1, 2], [3, 4]])
    fails(elementwise.col_broadcast(a, spark.createDataFrame([(0, 1.0)], "row_id bigint, c double"), "sub"))
    x, y = cells(spark, [(0, 1.0), (1, 2.0)], ["i"]), cells(spark, [(0, 1.0)], ["i"])
    fails(elementwise.cells_binary(x, y, ["i"], "add"))


def test_matmul_shapes_and_blocks(spark):
    rng = np.random.default_rng(0)
    a, b = rng.normal(size=(7, 5)), rng.normal(size=(5, 6))
    grid = lambda m, n: cells(spark, [(i, j, float(m[i, j])) for i in range(m.shape[0]) for j in range(m.shape[1])], n)
    for out in (linalg.cells_matmul(grid(a, ["i", "k"]), grid(b, ["k", "j"])), linalg.blocks_matmul(grid(a, ["i", "j"]), grid(b, ["i", "j"]), 2)):
        got = {(r.i, r.j): r.v for r in out.collect()}
        assert len(got) == 42 and all(abs(got[i, j] - (a @ b)[i, j]) < 1e-12 for i in range(7) for j in range(6))
    one, two = cells(spark, [(0, 0, 1.0), (0, 1, 1.0), (0, 2, 1.0)], ["i", "k"]), cells(spark, [(0, 0, 1.0), (1, 0, 1.0)], ["k", "j"])
    fails(linalg.cells_matmul(one, two))
    fails(linalg.blocks_matmul(one.withColumnRenamed("k", "j"), two.toDF("i", "j", "v"), 2))
    fails(linalg.vec_mat(one.select("k", F.col("v").alias("x")), two))
    fails(linalg.dot(one.select("k", F.col("v").alias("x")), two.select("k", F.col("v").alias("y"))))


def test_load_params_duplicates_and_collectives(spark):
    p = nn.params_to_table(spark, [nn.Linear(2, 1)], [np.ones((2, 1)), np.zeros(1)])
    fails(nn.load_params(p, p.unionByName(p.limit(1))))
    ranks = spark.createDataFrame([(0, 0, [1.0, 2.0]), (0, 1, [1.0])], "job int, rank int, vec array<double>")
    fails(collectives.gather(ranks, width=2))
    fails(collectives.broadcast_from(ranks.where("rank = 1")))


def test_unknown_names_raise(spark):
    class Odd:
        pass
    df = spark.createDataFrame([(0, [1.0], [1.0])], "row_id bigint, features array<double>, target array<double>")
    with pytest.raises(ValueError):
        nn.forward_rows(rows(spark, [[1.0]]), [Odd()], [])
    with pytest.raises(ValueError):
        TR.train(spark, df, "row_id", "features", "target", [nn.Linear(1, 1)], [np.ones((1, 1)), np.ones(1)], TR.TrainConfig(loss="mse", optimizer="odd"))
    with pytest.raises(ValueError):
        TR.train(spark, df, "row_id", "features", "target", [nn.Linear(1, 1)], [np.ones((1, 1)), np.ones(1)], TR.TrainConfig(loss="odd"))


def _sample(spark, n=60):
    rng = np.random.default_rng(5)
    x, y = rng.normal(size=(n, 3)), rng.normal(size=(n, 1))
    return x, y, spark.createDataFrame([(i, x[i].tolist(), y[i].tolist()) for i in range(n)], "row_id bigint, features array<double>, target array<double>")


def test_custom_layer_finite_differences(spark):
    from tablegrad.functions import kernels
    x, y, _ = _sample(spark)
    layers = [nn.Linear(3, 3), tanh_scale(3), nn.Linear(3, 1)]
    params = nn.init_params_np(layers, 1)
    w = np.full(len(x), 1 / len(x))
    loss = lambda p: kernels.batch_gradient(x, y, layers, p, "mse", w)[1].mean()
    grads, _ = kernels.batch_gradient(x, y, layers, params, "mse", w)
    for k, g in enumerate(grads):
        for at in np.ndindex(g.shape):
            a, b = [p.copy() for p in params], [p.copy() for p in params]
            a[k][at] += 1e-6
            b[k][at] -= 1e-6
            assert abs((loss(a) - loss(b)) / 2e-6 - g[at]) < 1e-6


def test_user_optimizer_and_steps(spark):
    x, y, df = _sample(spark)

    class Halving:
        def __init__(self):
            self.lr = 0.2

        def step(self, params, grads):
            out = [p - self.lr * g for p, g in zip(params, grads)]
            self.lr /= 2
            return out
    cfg = TR.TrainConfig(loss="mse", optimizer=Halving(), epochs=1, steps_per_epoch=2, batch_size=10, num_partitions=1)
    got, hist = TR.train(spark, df, "row_id", "features", "target", [nn.Linear(3, 1)], [np.zeros((3, 1)), np.zeros(1)], cfg)
    w, b, lr = np.zeros((3, 1)), np.zeros(1), 0.2
    for s in range(2):
        own = (np.arange(60) // 10) % 2 == s
        e = 2 * (x[own] @ w + b - y[own]) / own.sum()
        w, b, lr = w - lr * x[own].T @ e, b - lr * e.sum(0), lr / 2
    assert np.allclose(got[0], w) and np.allclose(got[1], b) and hist.count() == 2


def test_batch_norm_buffers_save_and_load(spark, tmp_path):
    x, y, df = _sample(spark)
    layers = [nn.BatchNorm1d(3), nn.Linear(3, 1)]
    cfg = TR.TrainConfig(loss="mse", epochs=2, batch_size=20, num_partitions=1, lr=0.1)
    params, buffers, _ = TR.train_with_buffers(spark, df, "row_id", "features", "target", layers, nn.init_params_np(layers, 1), cfg)
    m, v = np.zeros(3), np.ones(3)
    for _ in range(2):
        parts = [x[i:i + 20] for i in range(0, 60, 20)]
        m, v = 0.9 * m + 0.1 * np.mean([p.mean(0) for p in parts], 0), 0.9 * v + 0.1 * np.mean([p.var(0) for p in parts], 0)
    assert np.allclose(buffers[0][0], m) and np.allclose(buffers[0][1], v)
    nn.save_model(nn.params_to_table(spark, layers, params), str(tmp_path / "m"), TR.buffer_table(spark, buffers))
    table, held = nn.load_model(spark, str(tmp_path / "m"), with_buffers=True)
    assert all(np.allclose(a, b) for a, b in zip(nn.table_to_params(table, layers), params))
    assert {(r.j, round(r.running_mean, 9)) for r in held.collect()} == {(j, round(float(m[j]), 9)) for j in range(3)}
    assert {(r.running_mean, r.running_var) for r in nn.reset_buffers(held).collect()} == {(0.0, 1.0)}
    out = nn.forward_rows(df, layers, params, "features", "y", ["row_id"], bn_running=buffers).orderBy("row_id").collect()
    want = ((x - m) / np.sqrt(v + 1e-5) * params[0] + params[1]) @ params[2] + params[3]
    assert np.allclose([r.y for r in out], want)


def test_large_model_plans_quickly(spark):
    import time
    layers = nn.mlp([784, 128, 10])
    t = time.time()
    out = nn.forward_rows(rows(spark, np.zeros((5, 784)).tolist()), layers, nn.init_params_np(layers, 0))
    out.explain()
    assert time.time() - t < 5 and out.count() == 5


def test_no_cached_tables_left(spark):
    from tablegrad.plans.catalog import QUERIES
    for key in ("batchnorm_train", "minibatch_assign", "dp_gradient_mlp", "train_mlp_params"):
        QUERIES[key](spark, "/root/testdata/sf0.001").count()
    assert spark.sparkContext._jsc.getPersistentRDDs().size() == 0


def test_optimizer_name_of_table_steps(spark):
    with pytest.raises(ValueError):
        optim.iterate_table_steps(spark.range(1), lambda p: p, 1, optimizer="odd")
