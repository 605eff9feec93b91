"""Tiled matrices, their products and gradients; one-pass softmax; tree reduction."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tablegrad.operators import activations, packets, tiles

RNG = np.random.default_rng(2)


def cells(spark, x):
    return spark.createDataFrame([(i, j, float(x[i, j])) for i in range(x.shape[0]) for j in range(x.shape[1])], "i bigint, j bigint, v double")


def tiled(spark, x, size=4):
    return tiles.from_cells(cells(spark, x), *x.shape, size)


def dense(t):
    out = np.full((t.m, t.n), np.nan)
    for r in tiles.to_cells(t).collect():
        assert math.isnan(out[r.i, r.j])
        out[r.i, r.j] = r.v
    return out


@pytest.mark.parametrize("m,k,n", [(1, 1, 1), (4, 8, 4), (9, 13, 6), (3, 30, 17)])
@pytest.mark.parametrize("region,span", [(1, 1), (2, 3), (4, 64)])
def test_products_of_every_shape(spark, m, k, n, region, span):
    a, b = RNG.normal(size=(m, k)), RNG.normal(size=(k, n))
    assert np.allclose(dense(tiles.matmul(tiled(spark, a), tiled(spark, b), region=region, span=span)), a @ b)


def test_transposes_and_gradients(spark):
    a, b, g = RNG.normal(size=(7, 11)), RNG.normal(size=(11, 6)), RNG.normal(size=(7, 6))
    ta, tb, tg = (tiled(spark, x) for x in (a, b, g))
    both = tiles.matmul(tiled(spark, a.T.copy()), tiled(spark, b.T.copy()), transpose_a=True, transpose_b=True, region=1, span=1)
    assert np.allclose(dense(both), a @ b)
    da, db = tiles.grad_matmul(ta, tb, tg, region=2, span=1)
    assert np.allclose(dense(da), g @ b.T) and np.allclose(dense(db), a.T @ g)


def test_rows_tile_by_tile_and_column_sums(spark):
    x, y = RNG.normal(size=(10, 6)), RNG.normal(size=(10, 6))
    rows = spark.createDataFrame([(i, x[i].tolist()) for i in range(10)], "row_id bigint, vec array<double>").repartition(3)
    t = tiles.from_rows(rows, 10, 6, 4)
    assert np.array_equal(dense(t), x)
    assert np.allclose(dense(tiles.map_tiles(t, lambda v: v * 2)), x * 2)
    assert np.allclose(dense(tiles.combine(t, tiled(spark, y), lambda p, q: p * q)), x * y)
    s = tiles.column_sums(t)
    assert (s.m, s.n) == (1, 6) and np.allclose(dense(s)[0], x.sum(axis=0))
    assert np.allclose(dense(tiles.with_row(t, s, lambda p, q: p - q)), x - x.sum(axis=0))
    assert np.array_equal(dense(t.saved()), x)


def test_shapes_that_do_not_fit_fail(spark):
    a, b = RNG.normal(size=(8, 8)), RNG.normal(size=(9, 8))
    with pytest.raises(ValueError, match="8 x 8 by 9 x 8"):
        tiles.matmul(tiled(spark, a), tiled(spark, b))
    c = cells(spark, a)
    for bad in (c.where("NOT (i = 5 AND j = 2)"), c.unionByName(c.where("i = 0 AND j = 0")), c.unionByName(c.where("i = 7").withColumn("i", F.lit(8).cast("bigint")))):
        with pytest.raises(Exception, match="missing or there twice|outside the shape"):
            dense(tiles.from_cells(bad, 8, 8, 4))
    whole, hole = tiled(spark, a), tiles.from_cells(c.where("NOT (i >= 4 AND j >= 4)"), 8, 8, 4)  # a whole tile is missing
    for x, y in ((hole, whole), (whole, hole)):
        with pytest.raises(Exception, match="a tile is missing"):
            dense(tiles.matmul(x, y, region=1, span=1))
    with pytest.raises(Exception, match="a tile is missing"):
        dense(tiles.combine(hole, whole, lambda p, q: p + q))
    rows = spark.createDataFrame([(0, [1.0, 2.0]), (2, [1.0, 2.0])], "row_id bigint, vec array<double>")
    with pytest.raises(Exception, match="missing"):
        dense(tiles.from_rows(rows, 3, 2, 4))


# --- softmax in one pass

def test_log_sum_exp_of_any_size(spark):
    inf = float("inf")
    groups = {"wide": [-1000.0, 1000.0, 999.0, 0.0], "huge": [1e300, -1e300], "steps": [127.9, 128.1, -128.0, 383.9, 384.1], "one": [-5000.25], "none": [-inf, -inf],
              "some": [-inf, 3.0], "nan": [1.0, float("nan")], "top": [inf, 0.0], "many": RNG.normal(size=500).tolist(), "low": [-1e5 + i for i in range(700)],
              "edge": [128.0 + 256 * i for i in range(-3, 4)]}
    df = spark.createDataFrame([(k, float(v)) for k, vs in groups.items() for v in vs], "k string, v double").repartition(5)
    got = {r.k: r.lse for r in activations.log_sum_exp_by(df, ["k"]).collect()}
    for k, vs in groups.items():
        v = np.array(vs)
        m = v.max()
        want = m if m == -inf else np.nan if m == inf or np.isnan(m) else m + math.log(np.exp(v - m).sum())
        assert (math.isnan(want) and math.isnan(got[k])) or got[k] == want or abs(got[k] - want) <= 1e-12 * abs(want), k


@pytest.mark.parametrize("shape,axis", [((3, 4, 5), 0), ((3, 4, 5), 1), ((3, 4, 5), -1), ((50,), 0)])
def test_softmax_stream_along_any_axis(spark, shape, axis):
    x = RNG.uniform(-1000, 1000, shape)
    df = spark.createDataFrame([(i, float(v)) for i, v in enumerate(x.ravel())], "pos bigint, v double")
    e = np.exp(x - x.max(axis=axis, keepdims=True))
    p = {r.pos: r.p for r in activations.softmax_stream(df, shape, axis).collect()}
    assert np.allclose([p[i] for i in range(x.size)], (e / e.sum(axis=axis, keepdims=True)).ravel(), rtol=1e-12, atol=0)
    lse = {r.pos: r.lse for r in activations.log_sum_exp(df, shape, axis).collect()}
    want = (np.log(e.sum(axis=axis)) + x.max(axis=axis)).ravel()
    assert np.allclose([lse[i] for i in range(want.size)], want, rtol=1e-13)
    with pytest.raises(ValueError, match="axis"):
        activations.softmax_stream(df, shape, len(shape))


# --- tree reduction

@pytest.mark.parametrize("depth", [1, 2, 3])
def test_tree_sum(spark, depth):
    g = RNG.normal(size=(90, 5))
    df = spark.createDataFrame([(i % 3, g[i].tolist(), i) for i in range(90)], "block int, grad array<double>, n bigint").repartition(27)
    got = {r.block: (r.grad, r.n) for r in packets.tree_sum(df, depth, tasks=27).collect()}
    assert len(got) == 3
    for b in range(3):
        assert np.allclose(got[b][0], g[b::3].sum(axis=0)) and got[b][1] == sum(range(b, 90, 3))
    assert packets.tree_sum(df.limit(0), depth, tasks=27).count() == 0
    with pytest.raises(Exception, match="differ in size"):
        packets.tree_sum(df.unionByName(spark.createDataFrame([(0, [1.0], 1)], df.schema)), depth).collect()


def test_levels_fall_by_the_fan_in():
    assert packets.levels(1000, 1) == [] and packets.levels(1000, 2) == [32] and packets.levels(1000, 3) == [100, 10]
    assert packets.fan_in(1000, 3) == 10 and packets.levels(3, 5) == [2]
    with pytest.raises(ValueError):
        packets.levels(8, 0)


def test_packets_of_a_task_are_merged_before_the_shuffle(spark):
    """However many packets a task holds, it ships one a block."""
    for each in (2, 200):
        df = spark.range(0, 4 * each, 1, 4).select(F.lit(0).alias("block"), F.array(F.col("id").cast("double")).alias("grad"), F.lit(1).cast("bigint").alias("n"))
        first = packets._merge(df, False)
        assert first.count() == 4 and first.agg(F.sum("n")).first()[0] == 4 * each
