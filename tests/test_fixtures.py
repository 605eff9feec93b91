"""Hand-computed cases (the reference's unit tests) as small-table tests; tolerance 1e-6."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import collect_rows, rows
from tablegrad.functions import columns as C
from tablegrad.operators import collectives, elementwise, grads, linalg, reduce

TOL = 1e-6


def close(a, b):
    return np.allclose(np.asarray(a, dtype=float), np.asarray(b, dtype=float), atol=TOL)


def test_add_mul_dot(spark):
    df = spark.createDataFrame([([1.0, 2.0], [3.0, 4.0], [1.0, 2.0, 3.0], [4.0, 5.0, 6.0])],
                               "a array<double>, b array<double>, c array<double>, d array<double>")
    r = df.select(elementwise.ew_binary("a", "b", "add").alias("s"), elementwise.ew_binary("a", "b", "mul").alias("m"),
                  C.arr_dot("c", "d").alias("dot")).first()
    assert close(r.s, [4, 6]) and close(r.m, [3, 8]) and close(r.dot, 32)


def test_shape_mismatch_fails(spark):
    df = spark.createDataFrame([([1.0, 2.0, 3.0], [1.0, 2.0])], "a array<double>, b array<double>")
    with pytest.raises(Exception):
        df.select(elementwise.ew_binary("a", "b", "add")).collect()
    with pytest.raises(Exception):
        linalg.rows_times_small(rows(spark, [[1, 2, 3]]), np.ones((2, 2)), out_col="y").collect()


def test_backward_add_mul_chain(spark):
    df = spark.createDataFrame([(0, [2.0], [3.0], [4.0], [1.0])], "row_id bigint, a array<double>, b array<double>, "
                                                                  "c array<double>, g array<double>")
    da = grads.grad_add_broadcast(df, "g", "same").first()["grad"]
    assert close(da, [1.0])
    dm = df.select(*[x.alias(n) for x, n in zip(grads.grad_mul("a", "b", "g"), ["da", "db"])]).first()
    assert close(dm.da, [3.0]) and close(dm.db, [2.0])
    # (a + b) * c: d(a+b) = c * g, then add passes it through to a and b; dc = (a + b) * g
    s = df.select(elementwise.ew_binary("a", "b", "add").alias("s"), "c", "g")
    ds, dc = grads.grad_mul("s", "c", "g")
    r = s.select(ds.alias("ds"), dc.alias("dc")).first()
    assert close(r.ds, [4.0]) and close(r.dc, [5.0])


def test_matmul_variants(spark):
    a = rows(spark, [[1, 2, 3], [4, 5, 6]])
    w = np.array([[7, 8], [9, 10], [11, 12]], dtype=float)
    for method in ("expr", "arrow"):
        out = linalg.rows_times_small(a, w, vec_col="vec", out_col="vec", method=method)
        assert close(collect_rows(out), [[58, 64], [139, 154]])
    cells_a = a.select(F.col("row_id").alias("i"), F.posexplode("vec").alias("k", "v"))
    cells_w = spark.createDataFrame([(k, j, float(w[k, j])) for k in range(3) for j in range(2)], "k int, j int, v double")
    mm = {(r.i, r.j): r.v for r in linalg.cells_matmul(cells_a, cells_w).collect()}
    assert close([mm[(0, 0)], mm[(0, 1)], mm[(1, 0)], mm[(1, 1)]], [58, 64, 139, 154])
    mv = a.select(linalg.matvec("vec", np.array([7.0, 8.0, 9.0])).alias("y")).orderBy("y").collect()
    assert close([r.y for r in mv], [50, 122])
    vec = spark.createDataFrame([(0, 1.0), (1, 2.0), (2, 3.0)], "k int, x double")
    vm = {r.j: r.v for r in linalg.vec_mat(vec, cells_w).collect()}
    assert close([vm[0], vm[1]], [58, 64])


def test_backward_matmul_sum_loss(spark):
    a = spark.createDataFrame([(0, [1.0, 2.0], [1.0, 1.0]), (1, [3.0, 4.0], [1.0, 1.0])],
                              "row_id bigint, x array<double>, g array<double>")
    b = np.array([[5.0, 6.0], [7.0, 8.0]])
    for method in ("expr", "arrow"):
        dw, db, dx = grads.grad_linear(a, "x", "g", b, method=method)
        d = {(r.k, r.j): r.v for r in dw.collect()}
        assert close([d[(0, 0)], d[(0, 1)], d[(1, 0)], d[(1, 1)]], [4, 4, 6, 6])
    assert close(collect_rows(a.select("row_id", dx.alias("vec"))), [[11, 15], [11, 15]])


def test_linear_forward_and_backward(spark):
    x = rows(spark, [[1, 1, 1]])
    w = np.arange(1, 7, dtype=float).reshape(3, 2)
    out = linalg.rows_times_small(x, w, out_col="vec")
    assert close(collect_rows(out), [[9, 12]])
    df = spark.createDataFrame([(0, [1.0, 1.0], [1.0, 1.0])], "row_id bigint, x array<double>, g array<double>")
    w2 = np.array([[1.0, 2.0], [3.0, 4.0]])
    dw, db, dx = grads.grad_linear(df, "x", "g", w2)
    assert close(sorted(r.v for r in dw.collect()), [1, 1, 1, 1])
    assert close(sorted(r.v for r in db.collect()), [1, 1])
    assert close(df.select(dx.alias("dx")).first().dx, [3, 7])


def test_relu_sigmoid_and_grads(spark):
    df = spark.createDataFrame([([-1.0, 0.0, 2.0, 3.0], [1.0, 1.0, 1.0, 1.0], [0.0, 2.0, -2.0], [1.0, 1.0, 1.0])],
                               "x array<double>, g array<double>, s array<double>, gs array<double>")
    r = df.select(C.arr_unary("relu", "x").alias("y"), grads.grad_unary("relu", "x", "g").alias("dy"),
                  C.arr_unary("sigmoid", "s").alias("sy"), grads.grad_unary("sigmoid", "s", "gs").alias("dsy")).first()
    assert close(r.y, [0, 0, 2, 3]) and close(r.dy, [0, 0, 1, 1])
    y = 1 / (1 + np.exp(-np.array([0.0, 2.0, -2.0])))
    assert close(r.sy, y) and close(r.dsy, y * (1 - y))


def test_ieee_edges(spark):
    df = spark.createDataFrame([([0.0, -1.0, float("nan"), 4.0],)], "x array<double>")
    r = df.select(C.arr_unary("log", "x").alias("l"), C.arr_unary("reciprocal", "x").alias("r"),
                  C.arr_unary("relu", "x").alias("u"), C.arr_unary("pow", "x", 0.5).alias("p")).first()
    assert r.l[0] == float("-inf") and np.isnan(r.l[1]) and np.isnan(r.l[2])
    assert r.r[0] == float("inf") and r.r[3] == 0.25
    assert r.u[2] == 0.0
    assert np.isnan(r.p[1]) and r.p[3] == 2.0


def test_empty_reductions(spark):
    empty = spark.createDataFrame([], "row_id bigint, vec array<double>")
    assert reduce.sum_all(empty).first()[0] == 0.0
    assert np.isnan(reduce.mean_all(empty).first()[0])


def test_collectives(spark):
    def job(vecs):
        return spark.createDataFrame([(0, r, [float(v) for v in vec]) for r, vec in enumerate(vecs)],
                                     "job bigint, rank int, vec array<double>")
    b = collectives.broadcast_from(job([[42, 43], [0, 0], [0, 0], [0, 0]]), root=0).collect()
    assert all(close(r.vec, [42, 43]) for r in b) and len(b) == 4
    ar = collectives.all_reduce(job([[r + 1, r + 1] for r in range(4)])).collect()
    assert len(ar) == 8 and all(r.x == 10.0 for r in ar)
    g = collectives.gather(job([[r] for r in range(4)]), root=0, width=1).orderBy("pos").collect()
    assert [r.x for r in g] == [0.0, 1.0, 2.0, 3.0] and {r.rank for r in g} == {0}
    rs = collectives.reduce_scatter(job([[1, 1, 1, 1]] * 4), world=4, width=4).collect()
    assert sorted(r.rank for r in rs) == [0, 1, 2, 3] and all(r.x == 4.0 for r in rs)


def test_softmax_any_axis_and_invalid_axis(spark):
    from tablegrad.operators import activations
    rng = np.random.default_rng(2)
    x = rng.normal(size=(2, 3, 4))
    cells = spark.createDataFrame([(int(p), float(v)) for p, v in enumerate(x.ravel())], "pos bigint, v double")
    for axis in (0, 1, -1):
        got = np.zeros(x.size)
        for r in activations.softmax_cells(cells, x.shape, axis=axis).collect():
            got[r.pos] = r.p
        e = np.exp(x - x.max(axis=axis, keepdims=True))
        assert close(got.reshape(x.shape), e / e.sum(axis=axis, keepdims=True))
    with pytest.raises(ValueError):
        activations.softmax_cells(cells, x.shape, axis=3)
