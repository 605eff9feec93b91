"""Registered queries: products and gradients in cells, user-defined losses and layers, checked training, model files."""

from __future__ import annotations

import uuid

import numpy as np
from pyspark.sql import functions as F

from tablegrad.functions import columns as C
from tablegrad.operators import elementwise, grads, linalg, nn, reduce
from tablegrad.plans import data as D
from tablegrad.plans import sqlparts as S
from tablegrad.plans import train as TR
from tablegrad.plans.catalog import LI_KEYS, cells, register, weight_cells
from tablegrad.session import scratch_path
from tablegrad.sources import idx, kv

G = 10


def emb_cells(spark, d, i: str = "i", j: str = "k"):
    return D.emb_rows(spark, d).select(F.col("row_id").alias(i), F.posexplode("vec").alias(j, "v"))


# ================================================================ products in cells
MATMUL_SQL = (S.with_(S.EMB, S.weights("w", 64, 16)) + f"SELECT emb.row_id AS i, w.j, {S.r('sum(emb.x * w.w)')} AS v FROM emb "
              "JOIN w ON emb.j = w.k GROUP BY emb.row_id, w.j")


@register("matmul_cells", MATMUL_SQL)
def q_matmul_cells(spark, d):
    out = linalg.cells_matmul(emb_cells(spark, d), weight_cells(spark, 64, 16))
    return out.select("i", "j", C.tidy("v").alias("v"))


@register("matmul_blocks", MATMUL_SQL)
def q_matmul_blocks(spark, d):
    out = linalg.blocks_matmul(emb_cells(spark, d, "i", "j"), weight_cells(spark, 64, 16).withColumnRenamed("k", "i"), size=32)
    return out.select("i", F.col("j").cast("int").alias("j"), C.tidy("v").alias("v"))


@register("ew_add_cells", S.with_(S.EMB) + f"SELECT row_id AS i, j AS k, {S.r('x + 2.0 * x')} AS v FROM emb")
def q_ew_add_cells(spark, d):
    a = emb_cells(spark, d)
    out = elementwise.cells_binary(a, a.withColumn("v", F.col("v") * 2.0), ["i", "k"], "add")
    return out.select("i", "k", C.tidy("v").alias("v"))


@register("ew_scalar", S.with_(S.LI, S.LIC) + f"SELECT l_orderkey, l_linenumber, j, {S.r('2.0 - x')} AS v FROM lic")
def q_ew_scalar(spark, d):
    e = elementwise.ew_scalar("vec", 2.0, "sub", scalar_left=True)
    return cells(D.li_rows(spark, d).select(*LI_KEYS, e.alias("y")), LI_KEYS, "y")


@register("l2_norm_by", S.with_(S.EMB) + f"SELECT label, {S.r('sqrt(sum(x * x))')} AS l2 FROM emb GROUP BY label")
def q_l2_norm_by(spark, d):
    x = D.emb_rows(spark, d).select("label", F.explode("vec").alias("v"))
    return reduce.l2_norm_by(x, ["label"]).select("label", C.tidy("l2").alias("l2"))


# ================================================================ backward rules
@register("grad_mul_broadcast", S.with_(S.EMB, "g AS (SELECT row_id, j, x, 2.0 * x AS g FROM emb)")
          + f"SELECT 'scalar_dA' AS rule, row_id AS i, j, {S.r('0.5 * g', G)} AS grad FROM g UNION ALL "
          f"SELECT 'scalar_ds', CAST(0 AS BIGINT), 0, {S.r('sum(x * g)', G)} FROM g UNION ALL "
          f"SELECT 'row_dA', row_id, j, {S.r('g * (j + 1) / 64.0', G)} FROM g UNION ALL "
          f"SELECT 'row_db', CAST(0 AS BIGINT), j, {S.r('sum(x * g)', G)} FROM g GROUP BY j")
def q_grad_mul_broadcast(spark, d):
    """A * s and A * b (a row vector), upstream G = 2A: gradients of both operands of either product."""
    rows = D.emb_rows(spark, d).select("row_id", "vec", F.transform("vec", lambda x: x * 2.0).alias("g"))
    da, ds = grads.grad_mul_scalar(rows, "vec", "g", 0.5)
    ra, db = grads.grad_mul_row(rows, "vec", "g", (np.arange(64) + 1) / 64.0)
    each = rows.select("row_id", F.explode(F.array(F.struct(F.lit("scalar_dA").alias("rule"), da.alias("x")),
                                                   F.struct(F.lit("row_dA").alias("rule"), ra.alias("x")))).alias("r"))
    own = cells(each.select("row_id", "r.rule", "r.x"), ["rule", "row_id"], "x", v="grad", digits=G).withColumnRenamed("row_id", "i")
    zero = F.lit(0).cast("bigint").alias("i")
    s = ds.select(F.lit("scalar_ds").alias("rule"), zero, F.lit(0).alias("j"), C.tidy("ds", G).alias("grad"))
    b = db.select(F.lit("row_db").alias("rule"), zero, "j", C.tidy("grad", G).alias("grad"))
    return own.unionByName(s).unionByName(b)


@register("grad_softmax_axis0", S.with_(
    "c AS (SELECT vec_id AS row_id, CAST(generate_subscripts(embedding, 1) - 1 AS INTEGER) AS j, "
    "CAST(unnest(embedding) AS DOUBLE) AS x, CAST(unnest(list_reverse(embedding)) AS DOUBLE) AS g FROM embeddings)",
    "m AS (SELECT j, max(x) AS m FROM c GROUP BY j)", "e AS (SELECT row_id, c.j, exp(x - m) AS e, g FROM c JOIN m USING (j))",
    "s AS (SELECT j, sum(e) AS s FROM e GROUP BY j)", "y AS (SELECT row_id, e.j, e / s AS y, g FROM e JOIN s USING (j))",
    "t AS (SELECT j, sum(g * y) AS t FROM y GROUP BY j)") + f"SELECT row_id, j, {S.r('y * (g - t)', G)} AS grad FROM y JOIN t USING (j)")
def q_grad_softmax_axis0(spark, d):
    c = D.emb_rows(spark, d).select("row_id", F.posexplode(F.arrays_zip(F.col("vec").alias("x"), F.reverse("vec").alias("g"))).alias("j", "s")) \
        .select("row_id", "j", "s.x", "s.g")
    stats = c.groupBy("j").agg(F.max("x").alias("m"))
    e = c.join(stats, "j").withColumn("e", F.exp(F.col("x") - F.col("m")))
    y = e.join(e.groupBy("j").agg(F.sum("e").alias("s")), "j").select("row_id", "j", (F.col("e") / F.col("s")).alias("y"), "g")
    return grads.grad_softmax_cells(y, ["j"]).select("row_id", "j", C.tidy("dx", G).alias("grad"))


@register("grad_matmul_cells", S.with_(S.EMB, S.weights("w", 64, 16), "g AS (SELECT emb.row_id, w.j, 0.01 * (emb.row_id % 7 + w.j) AS g "
                                                                     "FROM (SELECT DISTINCT row_id FROM emb) emb, (SELECT DISTINCT j FROM w) w)")
          + f"SELECT 'dA' AS tensor, g.row_id AS i, w.k AS j, {S.r('sum(g.g * w.w)', 8)} AS grad FROM g JOIN w ON g.j = w.j GROUP BY g.row_id, w.k "
          f"UNION ALL SELECT 'dB', CAST(emb.j AS BIGINT), g.j, {S.r('sum(emb.x * g.g)', 8)} FROM emb JOIN g ON emb.row_id = g.row_id GROUP BY emb.j, g.j")
def q_grad_matmul_cells(spark, d):
    a = emb_cells(spark, d)
    g = D.emb_rows(spark, d).select(F.col("row_id").alias("i"), F.posexplode(F.sequence(F.lit(0), F.lit(15))).alias("j", "_s")).select(
        "i", "j", ((F.col("i") % 7 + F.col("j")) * 0.01).alias("v"))
    da, db = grads.grad_matmul_cells(a, weight_cells(spark, 64, 16), g)
    x = da.select(F.lit("dA").alias("tensor"), "i", F.col("j").cast("int").alias("j"), C.tidy("v", 8).alias("grad"))
    y = db.select(F.lit("dB").alias("tensor"), F.col("k").cast("bigint").alias("i"), F.col("j").cast("int").alias("j"), C.tidy("v", 8).alias("grad"))
    return x.unionByName(y)


# ================================================================ user-defined loss and layer
DELTA = 0.5
EMB_X3 = "x AS (SELECT vec_id, CAST(embedding[1] AS DOUBLE) AS f0, CAST(embedding[2] AS DOUBLE) AS f1, CAST(embedding[3] AS DOUBLE) AS f2, label / 10.0 AS t FROM embeddings)"


def emb_regression(spark, d):
    return D.emb_rows(spark, d).select("row_id", F.slice("vec", 1, 3).alias("features"), F.array(F.col("label") / 10.0).alias("target"))


def huber(out, target):
    """A user's loss: quadratic up to DELTA, linear beyond."""
    e = out - target
    small = np.abs(e) <= DELTA
    loss = np.where(small, 0.5 * e * e, DELTA * (np.abs(e) - 0.5 * DELTA))
    return loss.sum(axis=1), np.where(small, e, DELTA * np.sign(e))


def _one_layer_sql(pred: str, by_pred: str, ctes: list[str], rows: list[tuple[int, str, int, str]]) -> str:
    q = S.with_(EMB_X3, *ctes, f"p AS (SELECT *, {pred} AS p FROM x)", f"g AS (SELECT *, {by_pred} AS g FROM p)")
    return q + " UNION ALL ".join(f"SELECT {i} AS param_id, '{n}' AS name, CAST({pos} AS BIGINT) AS pos, {S.r(f'avg({e})', G)} AS grad FROM g"
                                  for i, n, pos, e in rows)


LINEAR3 = " + ".join(f"f{k} * {S.w_expr(k, 0)}" for k in range(3)) + f" + {S.b_expr(0)}"


@register("custom_loss_gradient", _one_layer_sql(LINEAR3, f"greatest(least(p - t, {DELTA}), -{DELTA})", [], [
    *((0, "0.weight", k, f"g * f{k}") for k in range(3)), (1, "0.bias", 0, "g")]))
def q_custom_loss_gradient(spark, d):
    layers, cfg = [nn.Linear(3, 1)], TR.TrainConfig(loss=huber)
    s = TR.prepare_samples(emb_regression(spark, d), "row_id", "features", "target", cfg, batched=False)
    out = TR.gradient_cells(TR.packets(s, layers, [D.formula_w(3, 1), D.formula_b(1)], cfg), layers)
    return out.select("param_id", "name", "pos", C.tidy("grad", G).alias("grad"))


def tanh_scale_forward(x, scale):
    y = np.tanh(x * scale)
    return y, (x, scale, y)


def tanh_scale_backward(saved, g):
    x, scale, y = saved
    inner = g * (1 - y * y)
    return inner * scale, [(inner * x).sum(axis=0)]


def tanh_scale(n: int) -> nn.CustomLayer:
    """A user's layer: y = tanh(x * s) with one scale per feature."""
    return nn.CustomLayer(tanh_scale_forward, tanh_scale_backward, (("scale", (n,)),), lambda rng: [rng.uniform(0.5, 1.5, n)], n)


SCALES = np.array([0.5, 1.0, 1.5])
_H = [f"tanh(f{k} * {SCALES[k]})" for k in range(3)]


@register("custom_layer_gradient", _one_layer_sql(
    " + ".join(f"{_H[k]} * {S.w_expr(k, 0)}" for k in range(3)) + f" + {S.b_expr(0)}", "2.0 * (p - t)", [], [
        *((0, "0.scale", k, f"g * {S.w_expr(k, 0)} * (1 - power({_H[k]}, 2)) * f{k}") for k in range(3)),
        *((1, "1.weight", k, f"g * {_H[k]}") for k in range(3)), (2, "1.bias", 0, "g")]))
def q_custom_layer_gradient(spark, d):
    layers, cfg = [tanh_scale(3), nn.Linear(3, 1)], TR.TrainConfig(loss="mse")
    s = TR.prepare_samples(emb_regression(spark, d), "row_id", "features", "target", cfg, batched=False)
    out = TR.gradient_cells(TR.packets(s, layers, [SCALES, D.formula_w(3, 1), D.formula_b(1)], cfg), layers)
    return out.select("param_id", "name", "pos", C.tidy("grad", G).alias("grad"))


# ================================================================ training with checked parameters
def _linear_steps_sql(lr: float, epochs: int, steps: int) -> str:
    ctes = [EMB_X3, f"xs AS (SELECT *, ((row_number() OVER (PARTITION BY vec_id % 4 ORDER BY vec_id) - 1) // 32) % {steps} AS s FROM x)",
            f"p0 AS (SELECT {S.w_expr(0, 0)} AS w0, {S.w_expr(1, 0)} AS w1, {S.w_expr(2, 0)} AS w2, {S.b_expr(0)} AS b)"]
    e = "2.0 * (f0 * w0 + f1 * w1 + f2 * w2 + b - t)"
    for k in range(epochs * steps):
        ctes.append(f"g{k} AS (SELECT avg({e} * f0) AS g0, avg({e} * f1) AS g1, avg({e} * f2) AS g2, avg({e}) AS gb FROM xs CROSS JOIN p{k} WHERE s = {k % steps})")
        ctes.append(f"p{k + 1} AS (SELECT w0 - {lr} * g0 AS w0, w1 - {lr} * g1 AS w1, w2 - {lr} * g2 AS w2, b - {lr} * gb AS b FROM p{k} CROSS JOIN g{k})")
    last = f"p{epochs * steps}"
    return S.with_(*ctes) + " UNION ALL ".join(f"SELECT {i} AS param_id, '{n}' AS name, CAST({pos} AS BIGINT) AS pos, {S.r(c, 9)} AS value FROM {last}"
                                               for i, n, pos, c in ((0, "0.weight", 0, "w0"), (0, "0.weight", 1, "w1"), (0, "0.weight", 2, "w2"), (1, "0.bias", 0, "b")))


@register("train_linear_steps", _linear_steps_sql(0.5, 2, 2))
def q_train_linear_steps(spark, d):
    """Two epochs of two global steps: step s takes the batches whose number is s modulo 2."""
    layers = [nn.Linear(3, 1)]
    cfg = TR.TrainConfig(loss="mse", lr=0.5, epochs=2, steps_per_epoch=2, batch_size=32, num_partitions=4)
    params, _ = TR.train(spark, emb_regression(spark, d), "row_id", "features", "target", layers, [D.formula_w(3, 1), D.formula_b(1)], cfg)
    return nn.params_to_table(spark, layers, params).withColumn("value", C.tidy("value", 9))


def _mlp_step_sql(s: int, lr: float) -> list[str]:
    """One forward and backward pass from the parameter tables w1_s, b1_s, w2_s, b2_s, and the next tables."""
    t = f"_{s}"
    return [x.replace("@", t).replace("#", f"_{s + 1}") for x in (
        "a0@ AS (SELECT emb.row_id, w1@.j, sum(emb.x * w1@.w) AS s FROM emb JOIN w1@ ON emb.j = w1@.k GROUP BY emb.row_id, w1@.j)",
        "h@ AS (SELECT a0@.row_id, a0@.j, a0@.s + b1@.b AS a, greatest(a0@.s + b1@.b, 0.0) AS h FROM a0@ JOIN b1@ ON a0@.j = b1@.j)",
        "z0@ AS (SELECT h@.row_id, w2@.j AS c, sum(h@.h * w2@.w) AS s FROM h@ JOIN w2@ ON h@.j = w2@.k GROUP BY h@.row_id, w2@.j)",
        "z@ AS (SELECT z0@.row_id, z0@.c, exp(z0@.s + b2@.b) AS e FROM z0@ JOIN b2@ ON z0@.c = b2@.j)",
        "pr@ AS (SELECT row_id, c, e / sum(e) OVER (PARTITION BY row_id) AS p FROM z@)",
        "gp@ AS (SELECT pr@.row_id, c, p, -(CASE WHEN c = label THEN 1.0 ELSE 0.0 END) / (p + 1e-12) / nk AS g FROM pr@ JOIN lab USING (row_id) CROSS JOIN nn)",
        "dz@ AS (SELECT row_id, c, p * (g - sum(g * p) OVER (PARTITION BY row_id)) AS dz FROM gp@)",
        "da@ AS (SELECT dz@.row_id, w2@.k AS j, sum(dz * w2@.w) AS g FROM dz@ JOIN w2@ ON dz@.c = w2@.j GROUP BY dz@.row_id, w2@.k)",
        "dm@ AS (SELECT da@.row_id, da@.j, CASE WHEN h@.a > 0 THEN g ELSE 0.0 END AS g FROM da@ JOIN h@ ON da@.row_id = h@.row_id AND da@.j = h@.j)",
        "gw1@ AS (SELECT emb.j AS k, dm@.j, sum(emb.x * g) AS g FROM emb JOIN dm@ ON emb.row_id = dm@.row_id GROUP BY emb.j, dm@.j)",
        "gw2@ AS (SELECT h@.j AS k, c AS j, sum(h * dz) AS g FROM h@ JOIN dz@ ON h@.row_id = dz@.row_id GROUP BY h@.j, c)",
        "gb1@ AS (SELECT j, sum(g) AS g FROM dm@ GROUP BY j)", "gb2@ AS (SELECT c AS j, sum(dz) AS g FROM dz@ GROUP BY c)",
        f"w1# AS (SELECT k, j, w - {lr} * g AS w FROM w1@ JOIN gw1@ USING (k, j))", f"w2# AS (SELECT k, j, w - {lr} * g AS w FROM w2@ JOIN gw2@ USING (k, j))",
        f"b1# AS (SELECT j, b - {lr} * g AS b FROM b1@ JOIN gb1@ USING (j))", f"b2# AS (SELECT j, b - {lr} * g AS b FROM b2@ JOIN gb2@ USING (j))")]


TRAIN_MLP_SQL = S.with_(S.EMB, "lab AS (SELECT vec_id AS row_id, label FROM embeddings)", "nn AS (SELECT count(*) * 10 AS nk FROM embeddings)",
                        S.weights("w1_0", 64, 16), S.bias("b1_0", 16), S.weights("w2_0", 16, 10, 3), S.bias("b2_0", 10),
                        *_mlp_step_sql(0, 0.5), *_mlp_step_sql(1, 0.5)) + (
    f"SELECT 0 AS param_id, '0.weight' AS name, CAST(k * 16 + j AS BIGINT) AS pos, {S.r('w', 9)} AS value FROM w1_2 UNION ALL "
    f"SELECT 1, '0.bias', j, {S.r('b', 9)} FROM b1_2 UNION ALL SELECT 2, '2.weight', k * 10 + j, {S.r('w', 9)} FROM w2_2 UNION ALL "
    f"SELECT 3, '2.bias', j, {S.r('b', 9)} FROM b2_2")


@register("train_mlp_params", TRAIN_MLP_SQL)
def q_train_mlp_params(spark, d):
    """Two data-parallel SGD steps of the 64-16-10 classifier from the formula parameters: the parameters after them."""
    from tablegrad.plans.catalog_train import MLP_LAYERS, emb_samples, mlp_params
    cfg = TR.TrainConfig(lr=0.5, epochs=2, batch_size=32, num_partitions=4)
    params, _ = TR.train(spark, emb_samples(spark, d), "row_id", "features", "target", MLP_LAYERS, mlp_params(), cfg)
    return nn.params_to_table(spark, MLP_LAYERS, params).withColumn("value", C.tidy("value", 9))


@register("train_blocks", TRAIN_MLP_SQL)
def q_train_blocks(spark, d):
    """The same two steps with parameters, activations and gradients as tables of 32 x 32 tiles."""
    from tablegrad.plans import train_blocks as TB
    from tablegrad.plans.catalog_train import MLP_LAYERS, emb_samples, mlp_params
    start = nn.params_to_table(spark, MLP_LAYERS, mlp_params())
    params, _ = TB.train_blocks(spark, emb_samples(spark, d), "row_id", "features", "target", MLP_LAYERS, start, TB.BlockConfig(steps=2, lr=0.5, size=32))
    return params.withColumn("value", C.tidy("value", 9))


# ================================================================ model and sample files
@register("model_roundtrip", S.with_(S.EMB, "c AS (SELECT j, avg(x) AS m FROM emb GROUP BY j)")
          + f"SELECT 0 AS param_id, '0.weight' AS name, CAST(j AS BIGINT) AS pos, {S.r('m', G)} AS value FROM c "
          "UNION ALL SELECT 1, '0.bias', CAST(0 AS BIGINT), 0.25")
def q_model_roundtrip(spark, d):
    """A model whose weights are the column means of the data, saved, loaded and copied into a fresh parameter table."""
    means = reduce.mean_axis0(D.emb_rows(spark, d)).select(F.lit(0).alias("param_id"), F.lit("0.weight").alias("name"),
                                                           F.col("j").cast("bigint").alias("pos"), F.col("mean").alias("value"))
    bias = D.table(spark, d, "embeddings").agg(F.lit(0.25).alias("value")).select(
        F.lit(1).alias("param_id"), F.lit("0.bias").alias("name"), F.lit(0).cast("bigint").alias("pos"), "value")
    path = scratch_path(spark, f"model-{uuid.uuid4().hex}")
    nn.save_model(means.unionByName(bias), path)
    fresh = nn.init_params_table(spark, [nn.Linear(64, 1)], seed=3)
    return nn.load_params(fresh, nn.load_model(spark, path)).withColumn("value", C.tidy("value", G))


@register("bn_reset", "SELECT CAST(j AS INTEGER) AS j, count(DISTINCT b) AS batches, CAST(0.0 AS DOUBLE) AS running_mean, CAST(1.0 AS DOUBLE) AS running_var FROM "
          "(SELECT event_id // 100 AS b, unnest([0, 1]) AS j FROM events) GROUP BY j")
def q_bn_reset(spark, d):
    """Running statistics of the event batches, reset to mean 0 and variance 1 (the batch count shows what was reset)."""
    x = D.table(spark, d, "events").select((F.col("event_id") / 100).cast("bigint").alias("b"),
                                           F.posexplode(F.array(F.col("value") / 100.0, F.col("user_id") / 100.0)).alias("j", "x"))
    stats = x.groupBy("b", "j").agg(F.avg("x").alias("mean"), F.var_pop("x").alias("var"))
    buffers = nn.running_stats(stats, "b", ["j"]).join(stats.groupBy("j").agg(F.count("*").alias("batches")), "j")
    return nn.reset_buffers(buffers).select("j", "batches", "running_mean", "running_var")


@register("kv_write_scan", S.with_(S.EMB) + f"SELECT printf('train_%05d', row_id) AS row_key, label AS label_idx, {S.r('sum(x)')} AS total "
          "FROM emb GROUP BY row_id, label")
def q_kv_write_scan(spark, d):
    """Samples written to a new key-value table in two batches (made by the first, extended by the second), then scanned."""
    from tablegrad.plans.catalog_io import kv_table
    t = kv_table(spark, d)
    path = scratch_path(spark, f"kv-{uuid.uuid4().hex}")
    half = F.pmod(F.xxhash64("row_key"), F.lit(2))
    kv.write(t.where(half == 0), path)
    kv.write(t.where(half == 1), path)
    s = kv.scan_samples(kv.read(spark, path))
    total = F.aggregate("features", F.lit(0.0), lambda a, x: a + x)
    return s.select("row_key", C.argmax("target").alias("label_idx"), C.tidy(total).alias("total"))


@register("idx_names", "SELECT CASE WHEN vec_id % 2 = 0 THEN 'train' ELSE 't10k' END AS shard, count(*) AS n, CAST(sum(label) AS BIGINT) AS label_sum "
          "FROM embeddings GROUP BY 1")
def q_idx_names(spark, d):
    """Image and label files under their standard names (train-images-idx3-ubyte.gz and so on), parsed and paired."""
    from tablegrad.plans.catalog_io import pixel_bytes, pixels
    rows = D.emb_rows(spark, d).select(F.when(F.col("row_id") % 2 == 0, "train").otherwise("t10k").alias("shard"),
                                       F.col("row_id").alias("idx"), pixel_bytes(pixels("vec")).alias("pixels"), "label")
    files = idx.idx_shard_files(rows, "shard", "idx", "pixels", "label", 8, 8)
    names = F.regexp_replace(F.regexp_replace("path", "images[.]idx", "images-idx3-ubyte"), "labels[.]idx", "labels-idx1-ubyte")
    paired = idx.pair_images_labels(idx.parse_files(files.withColumn("path", names)))
    return paired.groupBy("shard").agg(F.count("*").alias("n"), F.sum("label").cast("bigint").alias("label_sum"))
