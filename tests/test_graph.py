"""Gradients of expression graphs: the reference's small cases, finite differences for every operator, shared tensors."""

import numpy as np
import pytest

from tablegrad.operators.graph import Graph, topological

M, N = 5, 4
RNG = np.random.default_rng(11)
X, Y = RNG.uniform(0.3, 1.7, (M, N)), RNG.normal(size=(M, N))
CV, V, U = RNG.normal(size=M), RNG.uniform(0.2, 1.0, N), RNG.normal(size=3)
W = RNG.normal(size=(N, 3))


def table(spark, x=X, y=Y, c=CV):
    return spark.createDataFrame([(i, x[i].tolist(), y[i].tolist(), float(c[i])) for i in range(len(x))],
                                 "row_id bigint, x array<double>, y array<double>, c double")


def weight_table(spark, w=W):
    return spark.createDataFrame([(k, j, float(w[k, j])) for k in range(w.shape[0]) for j in range(w.shape[1])], "k int, j int, v double")


def array_of(df, kind):
    r = df.collect()
    if kind == "scalar":
        return np.array(r[0]["grad"])
    if kind in ("matrix", "column"):
        return np.array([x["grad"] for x in sorted(r, key=lambda x: x["row_id"])])
    if kind == "vector":
        return np.array([x["grad"] for x in sorted(r, key=lambda x: x["j"])])
    out = np.zeros((max(x["k"] for x in r) + 1, max(x["j"] for x in r) + 1))
    for x in r:
        out[x["k"], x["j"]] = x["grad"]
    return out


def softmax(z):
    e = np.exp(z - z.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


sig = lambda z: 1 / (1 + np.exp(-z))

# Each case: the expression over tensors, and the same over arrays (x, y: matrices, c: column, v: vector, w: weights, u: vector).
CASES = {
    "residual": (lambda x, y, c, v, w, u: ((x @ w).relu() @ u * c).sum() + ((x + y * x) * x).mean(),
                 lambda x, y, c, v, w, u: (np.maximum(x @ w, 0) @ u * c).sum() + ((x + y * x) * x).mean()),
    "centred": (lambda x, y, c, v, w, u: ((x - x.mean(0)) * (x - x.mean(0)) * y).sum(),
                lambda x, y, c, v, w, u: ((x - x.mean(0)) ** 2 * y).sum()),
    "softmax of a scaled matrix": (lambda x, y, c, v, w, u: (((x * v).softmax() + 0.1).log() * y).mean(),
                                   lambda x, y, c, v, w, u: (np.log(softmax(x * v) + 0.1) * y).mean()),
    "columns": (lambda x, y, c, v, w, u: (((x - x.mean(1)) * c).sum(1).pow(2.0) + (c * c).sigmoid()).mean(),
                lambda x, y, c, v, w, u: (((x - x.mean(1, keepdims=True)) * c[:, None]).sum(1) ** 2 + sig(c * c)).mean()),
    "unary chain": (lambda x, y, c, v, w, u: (x.sqrt().log() + x.reciprocal().pow(1.5) - (-y).sigmoid() + (2.0 - y).relu() / 3.0).sum(),
                    lambda x, y, c, v, w, u: (np.log(np.sqrt(x)) + x ** -1.5 - sig(-y) + np.maximum(2 - y, 0) / 3).sum()),
    "vectors": (lambda x, y, c, v, w, u: ((v @ w).softmax() @ u) * (v.sum() * v.mean()) + (x.sum(0) * v.sqrt()).mean(),
                lambda x, y, c, v, w, u: (softmax(v @ w) @ u) * (v.sum() * v.mean()) + (x.sum(0) * np.sqrt(v)).mean()),
    "a normalised by its own spread": (lambda x, y, c, v, w, u: (((x - x.mean(0)) / ((x - x.mean(0)).pow(2.0).mean(0) + 1e-3).sqrt()) * y).sum(),
                                       lambda x, y, c, v, w, u: ((x - x.mean(0)) / np.sqrt(((x - x.mean(0)) ** 2).mean(0) + 1e-3) * y).sum()),
    "scalar times its own matrix": (lambda x, y, c, v, w, u: (x * x.mean() + x.sum() * y.mean()).sum() - c.sum() * c.mean(),
                                    lambda x, y, c, v, w, u: (x * x.mean() + x.sum() * y.mean()).sum() - c.sum() * c.mean()),
}


def numeric(f, args, k):
    out, h = np.zeros_like(args[k]), 1e-6
    for i in np.ndindex(out.shape):
        up, down = [a.copy() for a in args], [a.copy() for a in args]
        up[k][i] += h
        down[k][i] -= h
        out[i] = (f(*up) - f(*down)) / (2 * h)
    return out


@pytest.mark.parametrize("held", ["driver", "table"])
@pytest.mark.parametrize("name", CASES)
def test_gradients_equal_finite_differences(spark, name, held):
    g = Graph(table(spark))
    kinds = ["matrix", "matrix", "column", "vector", "weights", "vector"]
    if held == "driver":
        leaves = [g.matrix("x"), g.matrix("y"), g.column("c"), g.vector(V), g.weights(W), g.vector(U)]
    elif name in ("residual", "vectors"):  # the cases with parameter tables
        rows = lambda v: spark.createDataFrame([(j, float(z)) for j, z in enumerate(v)], "j int, v double")
        leaves = [g.matrix("x"), g.matrix("y"), g.column("c"), g.vector(rows(V)), g.weights(weight_table(spark)), g.vector(rows(U))]
    else:
        pytest.skip("no parameters in this case")
    build, f = CASES[name]
    args = [X, Y, CV, V, W, U]
    root = build(*leaves)
    assert abs(g.values(root)[0].first()["v"] - f(*args)) < 1e-9
    used = [k for k, t in enumerate(leaves) if t in set(topological([root]))]
    for k, df in zip(used, g.gradients(root, [leaves[k] for k in used], save=held == "table")):
        assert np.allclose(array_of(df, kinds[k]), numeric(f, args, k), atol=1e-5), (name, k)


def one(spark, **values):
    return Graph(spark.createDataFrame([(0, *map(float, values.values()))], "row_id bigint, " + ", ".join(f"{k} double" for k in values)))


def test_small_cases(spark):
    g = one(spark, a=2, b=3, c=4)
    a, b, c = (g.column(x) for x in "abc")
    grad = lambda root, *wrt: [df.first()["grad"] for df in g.gradients(root, wrt)]
    assert grad(a + b, a, b) == [1.0, 1.0]
    assert grad(a * b, a, b) == [3.0, 2.0]
    assert grad((a + b) * c, a, b, c) == [4.0, 4.0, 5.0]
    assert grad(a * a * a, a) == [12.0]
    assert grad(a + b, c) == [0.0]
    m = Graph(spark.createDataFrame([(0, [1.0, 2.0]), (1, [3.0, 4.0])], "row_id bigint, a array<double>"))
    x, w = m.matrix("a"), m.weights([[5.0, 6.0], [7.0, 8.0]])
    dx, dw = m.gradients((x @ w).sum(), [x, w])
    assert array_of(dx, "matrix").tolist() == [[11.0, 15.0], [11.0, 15.0]]
    assert array_of(dw, "weights").tolist() == [[4.0, 4.0], [6.0, 6.0]]


def test_seeds(spark):
    g = Graph(table(spark))
    x = g.matrix("x")
    z = x * x
    ones, twice, own = (array_of(g.gradients(z, [x], seed=s)[0], "matrix") for s in (None, 2.0, "y"))
    assert np.allclose(ones, 2 * X) and np.allclose(twice, 4 * X) and np.allclose(own, 2 * X * Y)
    with pytest.raises(ValueError, match="per-row"):
        g.gradients(z.sum(), [x], seed="y")


def test_a_deep_chain_of_shared_tensors_is_computed_once_each(spark):
    g = Graph(table(spark))
    t = x = g.matrix("x")
    for _ in range(12):  # 2**12 ways from the root to the leaf
        t = (t + t) * 0.5
    assert len(topological([t])) == 1 + 12 * 3
    assert np.allclose(array_of(g.gradients(t.sum(), [x])[0], "matrix"), np.ones((M, N)))


def test_shapes_that_do_not_fit(spark):
    g = Graph(table(spark))
    x = g.matrix("x")
    with pytest.raises(ValueError):
        g.column("c") + g.vector(V)
    with pytest.raises(ValueError):
        x @ x
    for bad in (lambda: (x + g.vector(U)).sum(), lambda: (x @ g.weights(np.ones((3, 2)))).sum(), lambda: (x @ g.weights(weight_table(spark, np.ones((3, 2))))).sum()):
        with pytest.raises(Exception, match="differ|width|size"):
            g.values(bad())[0].collect()
    hole = weight_table(spark).where("NOT (k = 1 AND j = 2)")
    with pytest.raises(Exception, match="missing"):
        g.values((x @ g.weights(hole)).sum())[0].collect()
