"""Registered queries: layers, gradients, optimizers, batching and data-parallel training."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablegrad.functions import columns as C
from tablegrad.operators import batching, grads, nn, optim
from tablegrad.plans import data as D
from tablegrad.plans import sqlparts as S
from tablegrad.plans import train as TR
from tablegrad.plans.catalog import LI_KEYS, SOFTMAX_LOGITS_SQL, cells, emb_logits, register

GRAD_DIGITS = 10

# ---------------------------------------------------------------- shared fixtures of the gradient queries
MLP_LAYERS = [nn.Linear(64, 16), nn.ReLU(), nn.Linear(16, 10)]
LIN_LAYERS = [nn.Linear(64, 10)]
REG_LAYERS = [nn.Linear(3, 1)]


def mlp_params():
    return [D.formula_w(64, 16), D.formula_b(16), D.formula_w(16, 10, salt=3), D.formula_b(10)]


def lin_params():
    return [D.formula_w(64, 10), D.formula_b(10)]


def reg_params():
    return [D.formula_w(3, 1), D.formula_b(1)]


def emb_samples(spark, d) -> DataFrame:
    return D.emb_rows(spark, d).select("row_id", F.col("vec").alias("features"),
                                       C.one_hot("label", D.N_CLASSES).alias("target"))


def reg_samples(spark, d) -> DataFrame:
    """lineitem regression rows. Batching needs a total order: all columns, duplicates stay interchangeable."""
    li = D.table(spark, d, "lineitem")
    return li.select(F.xxhash64("l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount",
                                "l_tax").alias("row_id"),
                     F.array(F.col("l_quantity") / F.lit(50.0), F.col("l_discount") * F.lit(10.0),
                             F.col("l_tax") * F.lit(10.0)).alias("features"),
                     F.array(F.col("l_extendedprice") / F.lit(100000.0)).alias("target"))


def grad_table(pk: DataFrame, layers) -> DataFrame:
    return TR.gradient_cells(pk, layers).select("param_id", "name", "pos", C.tidy("grad", GRAD_DIGITS).alias("grad"))


def _packets(spark, d, layers, params, samples, cfg, batched: bool = False) -> DataFrame:
    s = TR.prepare_samples(samples, "row_id", "features", "target", cfg, TR.has_batch_norm(layers), batched)
    return TR.packets(s, layers, params, cfg)


# ---------------------------------------------------------------- SQL: relational back-propagation
def _mlp_grad_sql() -> str:
    g = GRAD_DIGITS
    return S.with_(
        S.EMB, S.weights("w1", 64, 16), S.bias("b1", 16), S.weights("w2", 16, 10, 3), S.bias("b2", 10),
        "a0 AS (SELECT emb.row_id, w1.j, sum(emb.x * w1.w) AS s FROM emb JOIN w1 ON emb.j = w1.k "
        "GROUP BY emb.row_id, w1.j)",
        "h AS (SELECT a0.row_id, a0.j, a0.s + b1.b AS a, CASE WHEN a0.s + b1.b > 0 THEN a0.s + b1.b ELSE 0.0 END AS h "
        "FROM a0 JOIN b1 ON a0.j = b1.j)",
        "z0 AS (SELECT h.row_id, w2.j AS c, sum(h.h * w2.w) AS s FROM h JOIN w2 ON h.j = w2.k GROUP BY h.row_id, w2.j)",
        "z AS (SELECT z0.row_id, z0.c, z0.s + b2.b AS z FROM z0 JOIN b2 ON z0.c = b2.j)",
        "mz AS (SELECT row_id, max(z) AS m FROM z GROUP BY row_id)",
        "ez AS (SELECT z.row_id, c, exp(z - m) AS e FROM z JOIN mz USING (row_id))",
        "sz AS (SELECT row_id, sum(e) AS s FROM ez GROUP BY row_id)",
        "pr AS (SELECT ez.row_id, c, e / s AS p FROM ez JOIN sz USING (row_id))",
        "lab AS (SELECT vec_id AS row_id, label FROM embeddings)",
        "nn AS (SELECT count(*) * 10 AS nk FROM embeddings)",
        "gp AS (SELECT pr.row_id, pr.c, pr.p, -(CASE WHEN pr.c = lab.label THEN 1.0 ELSE 0.0 END) / (pr.p + 1e-12) "
        "/ nn.nk AS g FROM pr JOIN lab USING (row_id) CROSS JOIN nn)",
        "gs AS (SELECT row_id, sum(g * p) AS s FROM gp GROUP BY row_id)",
        "dz AS (SELECT gp.row_id, gp.c, gp.p * (gp.g - gs.s) AS dz FROM gp JOIN gs USING (row_id))",
        "dw2 AS (SELECT h.j AS k, dz.c AS j, sum(h.h * dz.dz) AS g FROM h JOIN dz ON h.row_id = dz.row_id "
        "GROUP BY h.j, dz.c)",
        "db2 AS (SELECT c AS j, sum(dz) AS g FROM dz GROUP BY c)",
        "dh AS (SELECT dz.row_id, w2.k AS j, sum(dz.dz * w2.w) AS g FROM dz JOIN w2 ON dz.c = w2.j "
        "GROUP BY dz.row_id, w2.k)",
        "da AS (SELECT dh.row_id, dh.j, CASE WHEN h.a > 0 THEN dh.g ELSE 0.0 END AS g FROM dh "
        "JOIN h ON dh.row_id = h.row_id AND dh.j = h.j)",
        "dw1 AS (SELECT emb.j AS k, da.j AS j, sum(emb.x * da.g) AS g FROM emb JOIN da ON emb.row_id = da.row_id "
        "GROUP BY emb.j, da.j)",
        "db1 AS (SELECT j, sum(g) AS g FROM da GROUP BY j)") + (
        f"SELECT 0 AS param_id, '0.weight' AS name, k * 16 + j AS pos, {S.r('g', g)} AS grad FROM dw1 UNION ALL "
        f"SELECT 1, '0.bias', j, {S.r('g', g)} FROM db1 UNION ALL "
        f"SELECT 2, '2.weight', k * 10 + j, {S.r('g', g)} FROM dw2 UNION ALL "
        f"SELECT 3, '2.bias', j, {S.r('g', g)} FROM db2")


LIN_GRAD_CTES = SOFTMAX_LOGITS_SQL + [
    "nn AS (SELECT count(*) * 10 AS nk FROM embeddings)",
    "gp AS (SELECT pr.row_id, pr.c, pr.p, -(CASE WHEN pr.c = lab.label THEN 1.0 ELSE 0.0 END) / (pr.p + 1e-12) "
    "/ nn.nk AS g FROM pr JOIN lab USING (row_id) CROSS JOIN nn)",
    "gs AS (SELECT row_id, sum(g * p) AS s FROM gp GROUP BY row_id)",
    "dz AS (SELECT gp.row_id, gp.c, gp.p * (gp.g - gs.s) AS dz FROM gp JOIN gs USING (row_id))",
    "dw AS (SELECT emb.j AS k, dz.c AS j, sum(emb.x * dz.dz) AS g FROM emb JOIN dz ON emb.row_id = dz.row_id "
    "GROUP BY emb.j, dz.c)",
    "db AS (SELECT c AS j, sum(dz) AS g FROM dz GROUP BY c)",
    "lgrad AS (SELECT 0 AS param_id, '0.weight' AS name, k * 10 + j AS pos, g FROM dw "
    "UNION ALL SELECT 1, '0.bias', j, g FROM db)",
    "lparam AS (SELECT 0 AS param_id, '0.weight' AS name, k * 10 + j AS pos, w AS value FROM w "
    "UNION ALL SELECT 1, '0.bias', j, b FROM b)",
]


def linear_ce_grad_cells(spark, d) -> DataFrame:
    """Relational gradient of the 64->10 softmax cross entropy at the formula parameters (layout P cells)."""
    rows = emb_logits(spark, d).select("vec", grads.grad_cross_entropy_logits(
        C.arr_softmax("logits"), C.one_hot("label", D.N_CLASSES), 1.0 / D.N_CLASSES).alias("dz"))
    return grads.linear_param_grads(rows, "vec", "dz", D.formula_w(64, 10), mean=True)


def lin_param_table(spark) -> DataFrame:
    return nn.params_to_table(spark, LIN_LAYERS, lin_params())


# ================================================================ data-parallel gradients
@register("dp_gradient_mlp", _mlp_grad_sql())
def q_dp_gradient_mlp(spark, d):
    cfg = TR.TrainConfig(loss="cross_entropy", batch_size=32, num_partitions=4)
    return grad_table(_packets(spark, d, MLP_LAYERS, mlp_params(), emb_samples(spark, d), cfg), MLP_LAYERS)


@register("dp_gradient_barrier", _mlp_grad_sql())
def q_dp_gradient_barrier(spark, d):
    cfg = TR.TrainConfig(loss="cross_entropy", batch_size=32, num_partitions=4, barrier=True)
    return grad_table(_packets(spark, d, MLP_LAYERS, mlp_params(), emb_samples(spark, d), cfg), MLP_LAYERS)


def _reg_grad_sql() -> str:
    pred = " + ".join(f"f{k} * {S.w_expr(k, 0)}" for k in range(3)) + f" + {S.b_expr(0)}"
    g = GRAD_DIGITS
    return (S.with_("x AS (SELECT l_quantity / 50.0 AS f0, l_discount * 10.0 AS f1, l_tax * 10.0 AS f2, "
                    "l_extendedprice / 100000.0 AS t FROM lineitem)",
                    f"e AS (SELECT 2.0 * (({pred}) - t) AS e, f0, f1, f2 FROM x)",
                    "s AS (SELECT avg(e * f0) AS g0, avg(e * f1) AS g1, avg(e * f2) AS g2, avg(e) AS gb FROM e)")
            + f"SELECT 0 AS param_id, '0.weight' AS name, 0 AS pos, {S.r('g0', g)} AS grad FROM s UNION ALL "
            f"SELECT 0, '0.weight', 1, {S.r('g1', g)} FROM s UNION ALL "
            f"SELECT 0, '0.weight', 2, {S.r('g2', g)} FROM s UNION ALL "
            f"SELECT 1, '0.bias', 0, {S.r('gb', g)} FROM s")


@register("dp_gradient_linear", _reg_grad_sql())
def q_dp_gradient_linear(spark, d):
    """Linear regression gradient: per-row expressions, then one ``[X, 1]ᵀ·G`` aggregate (numpy per Arrow batch)."""
    rows = D.li_regression(spark, d)
    # d(mean loss) = mean over rows of the per-row gradient: averaged in the aggregate, one scan in total
    rows = rows.select("features", grads.grad_mse(C.vec_matmul("features", D.formula_w(3, 1), D.formula_b(1)),
                                                  "target", 1.0).alias("dz"))
    out = grads.linear_param_grads(rows, "features", "dz", D.formula_w(3, 1), mean=True)
    return out.select("param_id", "name", "pos", C.tidy("grad", GRAD_DIGITS).alias("grad"))


def _train_linear_sql(lr: float, steps: int) -> str:
    ctes = ["x AS (SELECT l_quantity / 50.0 AS f0, l_discount * 10.0 AS f1, l_tax * 10.0 AS f2, "
            "l_extendedprice / 100000.0 AS t FROM lineitem)",
            f"p0 AS (SELECT {S.w_expr(0, 0)} AS w0, {S.w_expr(1, 0)} AS w1, {S.w_expr(2, 0)} AS w2, "
            f"{S.b_expr(0)} AS b)"]
    for s in range(steps):
        ctes.append(f"g{s} AS (SELECT avg(2.0 * (f0 * w0 + f1 * w1 + f2 * w2 + b - t) * f0) AS g0, "
                    f"avg(2.0 * (f0 * w0 + f1 * w1 + f2 * w2 + b - t) * f1) AS g1, "
                    f"avg(2.0 * (f0 * w0 + f1 * w1 + f2 * w2 + b - t) * f2) AS g2, "
                    f"avg(2.0 * (f0 * w0 + f1 * w1 + f2 * w2 + b - t)) AS gb FROM x CROSS JOIN p{s})")
        ctes.append(f"p{s + 1} AS (SELECT w0 - {lr} * g0 AS w0, w1 - {lr} * g1 AS w1, w2 - {lr} * g2 AS w2, "
                    f"b - {lr} * gb AS b FROM p{s} CROSS JOIN g{s})")
    last = f"p{steps}"
    dg = 9
    return S.with_(*ctes) + (
        f"SELECT 0 AS param_id, '0.weight' AS name, 0 AS pos, {S.r('w0', dg)} AS value FROM {last} UNION ALL "
        f"SELECT 0, '0.weight', 1, {S.r('w1', dg)} FROM {last} UNION ALL "
        f"SELECT 0, '0.weight', 2, {S.r('w2', dg)} FROM {last} UNION ALL "
        f"SELECT 1, '0.bias', 0, {S.r('b', dg)} FROM {last}")


@register("train_linear", _train_linear_sql(0.5, 2))
def q_train_linear(spark, d):
    cfg = TR.TrainConfig(loss="mse", optimizer="sgd", lr=0.5, epochs=2, batch_size=256, num_partitions=8)
    params, _ = TR.train(spark, reg_samples(spark, d), "row_id", "features", "target", REG_LAYERS, reg_params(), cfg)
    return nn.params_to_table(spark, REG_LAYERS, params).select("param_id", "name", "pos",
                                                                C.tidy("value", 9).alias("value"))


def train_mlp_history(spark, d, epochs: int = 3) -> DataFrame:
    cfg = TR.TrainConfig(loss="cross_entropy", optimizer="adam", lr=0.01, epochs=epochs, batch_size=32,
                         num_partitions=4)
    _, hist = TR.train(spark, emb_samples(spark, d), "row_id", "features", "target", MLP_LAYERS,
                       nn.init_params_np(MLP_LAYERS, seed=7), cfg)
    return hist


@register("train_mlp")
def q_train_mlp(spark, d):
    return train_mlp_history(spark, d, epochs=3)


def _partition_loss_sql() -> str:
    return S.with_(*SOFTMAX_LOGITS_SQL,
                   "rl AS (SELECT pr.row_id, sum(-(CASE WHEN pr.c = lab.label THEN 1.0 ELSE 0.0 END) "
                   "* ln(pr.p + 1e-12)) AS l FROM pr JOIN lab USING (row_id) GROUP BY pr.row_id)",
                   "bt AS (SELECT row_id, l, CAST(row_id % 4 AS INTEGER) AS part, CAST((row_number() OVER "
                   "(PARTITION BY row_id % 4 ORDER BY row_id) - 1) // 32 AS INTEGER) AS batch_id FROM rl)",
                   "bl AS (SELECT part, batch_id, sum(l) / (count(*) * 10) AS bl, count(*) AS n FROM bt "
                   "GROUP BY part, batch_id)") + (
        f"SELECT part, CAST(count(*) AS INTEGER) AS batches, CAST(sum(n) AS BIGINT) AS n, {S.r('avg(bl)')} AS avg_batch_loss "
        "FROM bl GROUP BY part")


@register("partition_loss", _partition_loss_sql())
def q_partition_loss(spark, d):
    cfg = TR.TrainConfig(loss="cross_entropy", batch_size=32, num_partitions=4)
    pk = _packets(spark, d, LIN_LAYERS, lin_params(), emb_samples(spark, d), cfg, batched=True)
    return TR.partition_losses(pk, D.N_CLASSES).select("part", "batches", "n",
                                                       C.tidy("avg_batch_loss").alias("avg_batch_loss"))


@register("accuracy", S.with_(*SOFTMAX_LOGITS_SQL[:-5], "pred AS (SELECT row_id, arg_max(c, z) AS c FROM lg2 "
                                                          "GROUP BY row_id)",
                              "lab AS (SELECT vec_id AS row_id, label FROM embeddings)")
          + f"SELECT {S.r('avg(CASE WHEN pred.c = lab.label THEN 1.0 ELSE 0.0 END)')} AS accuracy "
          "FROM pred JOIN lab USING (row_id)")
def q_accuracy(spark, d):
    return emb_logits(spark, d).agg(
        F.avg((C.argmax("logits") == F.col("label")).cast("double")).alias("accuracy")).select(
        C.tidy("accuracy").alias("accuracy"))


@register("sample_count", "SELECT count(*) AS n FROM embeddings")
def q_sample_count(spark, d):
    return emb_samples(spark, d).agg(F.count("*").alias("n"))


def _input_sum_loss(out, target):
    """Row loss sum(out * target): its gradient by the output is the target."""
    return (out * target).sum(axis=1), target


@register("grad_tree_sum", S.with_(S.EMB) + f"SELECT j AS pos, {S.r('sum(x)')} AS total FROM emb GROUP BY j")
def q_grad_tree_sum(spark, d):
    """Packets of every task reduced by the training loop's own two-level sum; a loss whose gradient is the input row
    itself makes the bias gradient the column sums."""
    cfg = TR.TrainConfig(loss=_input_sum_loss, num_partitions=16)
    rows = D.emb_rows(spark, d).select("row_id", F.col("vec").alias("features"), F.col("vec").alias("target"))
    zero = [np.zeros((64, 64)), np.zeros(64)]
    pk = _packets(spark, d, [nn.Linear(64, 64)], zero, rows, cfg)
    grad = TR.gradient_cells(pk, [nn.Linear(64, 64)]).where("param_id = 1")
    n = pk.where("kind = 1").agg(F.sum("n")).scalar()
    return grad.select("pos", C.tidy(F.col("grad") * n * 64).alias("total"))


@register("group_by_partition", "SELECT vec_id AS row_id, CAST(vec_id % 4 AS INTEGER) AS part, "
          "row_number() OVER (PARTITION BY vec_id % 4 ORDER BY vec_id) - 1 AS pos_in_part FROM embeddings")
def q_group_by_partition(spark, d):
    b = batching.assign_batches(D.emb_rows(spark, d), "row_id", 4, 32)
    return b.select("row_id", "part", F.col("row_in_part").alias("pos_in_part"))


# ================================================================ batching
@register("minibatch_assign", "SELECT o_orderkey AS id, CAST(o_orderkey % 8 AS INTEGER) AS part, "
          "CAST((row_number() OVER (PARTITION BY o_orderkey % 8 ORDER BY o_orderkey) - 1) // 64 AS INTEGER) "
          "AS batch_id FROM orders")
def q_minibatch_assign(spark, d):
    b = batching.assign_batches(D.table(spark, d, "orders").select(F.col("o_orderkey").alias("id")), "id", 8, 64)
    return b.select("id", "part", "batch_id")


@register("minibatch_stack", "WITH b AS (SELECT o_orderkey, o_totalprice, CAST(o_orderkey % 8 AS INTEGER) AS part, "
          "CAST((row_number() OVER (PARTITION BY o_orderkey % 8 ORDER BY o_orderkey) - 1) // 64 AS INTEGER) "
          "AS batch_id FROM orders) SELECT part, batch_id, CAST(count(*) AS INTEGER) AS rows, min(o_orderkey) AS "
          f"first_id, max(o_orderkey) AS last_id, {S.r('sum(o_totalprice / 100000.0)')} AS feature_sum "
          "FROM b GROUP BY part, batch_id")
def q_minibatch_stack(spark, d):
    o = D.table(spark, d, "orders").select(F.col("o_orderkey").alias("id"),
                                           F.array(F.col("o_totalprice") / F.lit(100000.0)).alias("x"))
    st = batching.minibatch_stack(batching.assign_batches(o, "id", 8, 64), "id", "x")
    return st.select("part", "batch_id", "rows", F.element_at("ids", 1).alias("first_id"),
                     F.element_at("ids", -1).alias("last_id"),
                     C.tidy(F.aggregate("features", F.lit(0.0), lambda a, x: a + x[0])).alias("feature_sum"))


@register("minibatch_shuffle", "SELECT id, CAST(id % 8 AS INTEGER) AS part, (row_number() OVER (PARTITION BY id % 8 ORDER BY x, id) - 1) // 64 "
          "AS batch_id FROM (SELECT o_orderkey AS id, ((((42 * 1000003 + 1) % 2147483647 + o_orderkey % 2147483647 + 1) * 48271) % 2147483647 "
          "* 69621 + 12345) % 2147483647 AS x FROM orders)")
def q_minibatch_shuffle(spark, d):
    """A reproducible shuffled batching: the exact batch of every id."""
    b = batching.assign_batches(D.table(spark, d, "orders").select(F.col("o_orderkey").alias("id")), "id", 8, 64,
                                shuffle_seed=42, epoch=1)
    return b.select("id", "part", "batch_id")


@register("num_batches", "SELECT CAST(o_orderkey % 8 AS INTEGER) AS part, count(*) AS n, "
          "CAST(ceil(count(*) / 64.0) AS INTEGER) AS batches FROM orders GROUP BY 1")
def q_num_batches(spark, d):
    return batching.num_batches(D.table(spark, d, "orders"), "o_orderkey", 8, 64)


@register("partition_balance", "SELECT CAST(o_orderkey % 16 AS INTEGER) AS part, count(*) AS n FROM orders GROUP BY 1")
def q_partition_balance(spark, d):
    return batching.partition_balance(D.table(spark, d, "orders"), "o_orderkey", 16)


# ================================================================ layers and parameters
@register("linear_forward", S.with_(*SOFTMAX_LOGITS_SQL[:5]) + f"SELECT row_id, c AS j, {S.r('z')} AS v FROM lg2")
def q_linear_forward(spark, d):
    return cells(emb_logits(spark, d), ["row_id"], "logits")


@register("mlp_forward", S.with_(
    S.EMB, S.weights("w1", 64, 16), S.bias("b1", 16), S.weights("w2", 16, 10, 3), S.bias("b2", 10),
    "a0 AS (SELECT emb.row_id, w1.j, sum(emb.x * w1.w) AS s FROM emb JOIN w1 ON emb.j = w1.k GROUP BY emb.row_id, w1.j)",
    "h AS (SELECT a0.row_id, a0.j, CASE WHEN a0.s + b1.b > 0 THEN a0.s + b1.b ELSE 0.0 END AS h "
    "FROM a0 JOIN b1 ON a0.j = b1.j)",
    "z0 AS (SELECT h.row_id, w2.j AS c, sum(h.h * w2.w) AS s FROM h JOIN w2 ON h.j = w2.k GROUP BY h.row_id, w2.j)",
    "z AS (SELECT z0.row_id, z0.c, z0.s + b2.b AS z FROM z0 JOIN b2 ON z0.c = b2.j)",
    "mz AS (SELECT row_id, max(z) AS m FROM z GROUP BY row_id)",
    "ez AS (SELECT z.row_id, c, exp(z - m) AS e FROM z JOIN mz USING (row_id))",
    "sz AS (SELECT row_id, sum(e) AS s FROM ez GROUP BY row_id)")
    + f"SELECT ez.row_id, c AS j, {S.r('e / s')} AS p FROM ez JOIN sz USING (row_id)")
def q_mlp_forward(spark, d):
    layers = MLP_LAYERS + [nn.Softmax()]
    out = nn.forward_rows(D.emb_rows(spark, d), layers, mlp_params(), out_col="p", keep=["row_id"])
    return cells(out, ["row_id"], "p", v="p")


@register("sequential_forward", S.with_(
    S.EMB, S.weights("w1", 64, 16), S.bias("b1", 16), S.weights("w2", 16, 10, 3), S.bias("b2", 10),
    "a0 AS (SELECT emb.row_id, w1.j, sum(emb.x * w1.w) AS s FROM emb JOIN w1 ON emb.j = w1.k GROUP BY emb.row_id, w1.j)",
    "h AS (SELECT a0.row_id, a0.j, 1.0 / (1.0 + exp(-(a0.s + b1.b))) AS h FROM a0 JOIN b1 ON a0.j = b1.j)",
    "z0 AS (SELECT h.row_id, w2.j AS c, sum(h.h * w2.w) AS s FROM h JOIN w2 ON h.j = w2.k GROUP BY h.row_id, w2.j)")
    + f"SELECT z0.row_id, z0.c AS j, {S.r('z0.s + b2.b')} AS v FROM z0 JOIN b2 ON z0.c = b2.j")
def q_sequential_forward(spark, d):
    layers = [nn.Linear(64, 16), nn.Sigmoid(), nn.Linear(16, 10)]
    out = nn.forward_rows(D.emb_rows(spark, d), layers, mlp_params(), out_col="y", keep=["row_id"])
    return cells(out, ["row_id"], "y")


def _uniform_sql(seed: int, *keys: str) -> str:
    x = f"CAST({seed % 2147483647} AS BIGINT)"
    for k in keys:
        x = f"((({x} + {k} + 1) * 48271) % 2147483647 * 69621 + 12345) % 2147483647"
    return f"(({x}) % 1000003) / 1000003.0"


def _init_sql() -> str:
    parts = []
    for pid, (name, n, fan) in enumerate((("0.weight", "width * 16", "width + 16"), ("0.bias", "16", None),
                                          ("2.weight", "16 * classes", "16 + classes"), ("2.bias", "classes", None))):
        u = _uniform_sql(11, str(pid), "pos")
        value = f"(2 * {u} - 1) * sqrt(6.0 / ({fan}))" if fan else u
        parts.append(f"SELECT {pid} AS param_id, '{name}' AS name, pos, {S.r(value)} AS value FROM "
                     f"(SELECT unnest(range(0, {n})) AS pos, width, classes FROM m)")
    return "WITH m AS (SELECT max(len(embedding)) AS width, max(label) + 1 AS classes FROM embeddings) " + " UNION ALL ".join(parts)


@register("init_params", _init_sql())
def q_init_params(spark, d):
    """Seeded initialisation of a model sized by the whole table: its widest row and its number of classes."""
    width, classes = D.emb_rows(spark, d).agg(F.max(F.size("vec")), F.max("label") + 1).first()
    return nn.init_params_table(spark, nn.mlp([width, 16, classes]), seed=11).withColumn("value", C.tidy("value"))


@register("param_summary", S.with_(*LIN_GRAD_CTES) + (
    f"SELECT param_id, name, count(*) AS n, {S.r('sqrt(sum(g * g))', GRAD_DIGITS)} AS l2, "
    f"{S.r('avg(g)', GRAD_DIGITS)} AS mean FROM lgrad GROUP BY param_id, name"))
def q_param_summary(spark, d):
    s = nn.param_summary(linear_ce_grad_cells(spark, d), value="grad")
    return s.select("param_id", "name", "n", C.tidy("l2", GRAD_DIGITS).alias("l2"),
                    C.tidy("mean", GRAD_DIGITS).alias("mean"))


@register("load_params", S.with_(*LIN_GRAD_CTES)
          + f"SELECT param_id, name, pos, {S.r('g', GRAD_DIGITS)} AS value FROM lgrad")
def q_load_params(spark, d):
    """copyFrom: the formula parameter table takes the values of a data-derived table of the same shape."""
    incoming = linear_ce_grad_cells(spark, d).select("param_id", "pos", F.col("grad").alias("value"))
    out = nn.load_params(lin_param_table(spark), incoming)
    return out.select("param_id", "name", "pos", C.tidy("value", GRAD_DIGITS).alias("value"))


# ================================================================ gradient rules
@register("grad_bias", S.with_(*LIN_GRAD_CTES) + f"SELECT j, {S.r('g', GRAD_DIGITS)} AS grad FROM db")
def q_grad_bias(spark, d):
    g = linear_ce_grad_cells(spark, d).where(F.col("param_id") == 1)
    return g.select(F.col("pos").alias("j"), C.tidy("grad", GRAD_DIGITS).alias("grad"))


@register("grad_matmul", S.with_(*LIN_GRAD_CTES,
                                 "dx AS (SELECT dz.row_id, w.k, sum(dz.dz * w.w) AS g FROM dz JOIN w ON dz.c = w.j "
                                 "GROUP BY dz.row_id, w.k)")
          + f"SELECT 'dW' AS tensor, CAST(k AS BIGINT) AS i, j, {S.r('g', GRAD_DIGITS)} AS grad FROM dw UNION ALL "
          f"SELECT 'dX', row_id, k, {S.r('g', GRAD_DIGITS)} FROM dx")
def q_grad_matmul(spark, d):
    rows = emb_logits(spark, d).select("row_id", "vec", grads.grad_cross_entropy_logits(
        C.arr_softmax("logits"), C.one_hot("label", D.N_CLASSES), 1.0 / D.N_CLASSES).alias("dz"))
    n = D.table(spark, d, "embeddings").agg(F.count("*").cast("double")).scalar()
    dw, _, dx = grads.grad_linear(rows, "vec", "dz", D.formula_w(64, 10), bias=False, mean=True)
    dx, rows = F.transform(dx, lambda x: x / F.col("n")), rows.withColumn("n", n)
    a = dw.select(F.lit("dW").alias("tensor"), F.col("k").cast("bigint").alias("i"), F.col("j").cast("int").alias("j"),
                  C.tidy("v", GRAD_DIGITS).alias("grad"))
    b = cells(rows.select("row_id", dx.alias("dx")), ["row_id"], "dx", digits=GRAD_DIGITS).select(
        F.lit("dX").alias("tensor"), F.col("row_id").alias("i"), "j", F.col("v").alias("grad"))
    return a.unionByName(b)


def _emb_rev_sql(expr: str, op: str) -> str:
    return (f"SELECT '{op}' AS op, row_id, j, {S.r(expr, GRAD_DIGITS)} AS grad FROM (SELECT vec_id AS row_id, "
            "CAST(generate_subscripts(embedding, 1) - 1 AS INTEGER) AS j, CAST(unnest(embedding) AS DOUBLE) AS x, "
            "CAST(unnest(list_reverse(embedding)) AS DOUBLE) AS g FROM embeddings)")


UNARY_GRAD_SQL = {
    "neg": "-g",
    "pow": "3.0 * g * power(x, 2.0)",
    "sqrt": "0.5 * g * power(exp(x), -0.5)",
    "reciprocal": "-g / (x * x)",
    "log": "g / x",
    "relu": "CASE WHEN x > 0 THEN g ELSE 0.0 END",
    "sigmoid": "g * (1.0 / (1.0 + exp(-x))) * (1.0 - 1.0 / (1.0 + exp(-x)))",
}


@register("grad_unary", " UNION ALL ".join(_emb_rev_sql(e, op) for op, e in UNARY_GRAD_SQL.items()))
def q_grad_unary(spark, d):
    rows = D.emb_rows(spark, d).select("row_id", "vec", F.reverse("vec").alias("g"))
    def rule(op):
        x = F.transform("vec", lambda v: F.exp(v)) if op == "sqrt" else "vec"
        return grads.grad_unary(op, x, "g", p=3.0 if op == "pow" else None)

    # one scan: all rules side by side, one row per (row, rule)
    each = rows.select("row_id", F.explode(F.array(*[F.struct(F.lit(op).alias("op"), rule(op).alias("dx")) for op in UNARY_GRAD_SQL])).alias("r"))
    return cells(each.select("row_id", "r.op", "r.dx"), ["op", "row_id"], "dx", v="grad", digits=GRAD_DIGITS)


@register("grad_softmax", S.with_(
    "c AS (SELECT vec_id AS row_id, CAST(generate_subscripts(embedding, 1) - 1 AS INTEGER) AS j, "
    "CAST(unnest(embedding) AS DOUBLE) AS x, CAST(unnest(list_reverse(embedding)) AS DOUBLE) AS g FROM embeddings)",
    "m AS (SELECT row_id, max(x) AS m FROM c GROUP BY row_id)",
    "e AS (SELECT c.row_id, j, exp(x - m) AS e, g FROM c JOIN m USING (row_id))",
    "s AS (SELECT row_id, sum(e) AS s FROM e GROUP BY row_id)",
    "y AS (SELECT e.row_id, j, e / s AS y, g FROM e JOIN s USING (row_id))",
    "t AS (SELECT row_id, sum(g * y) AS t FROM y GROUP BY row_id)")
    + f"SELECT row_id, j, {S.r('y * (g - t)', GRAD_DIGITS)} AS grad FROM y JOIN t USING (row_id)")
def q_grad_softmax(spark, d):
    rows = D.emb_rows(spark, d).select("row_id", C.arr_softmax("vec").alias("y"), F.reverse("vec").alias("g"))
    return cells(rows.select("row_id", grads.grad_softmax("y", "g").alias("dx")), ["row_id"], "dx", v="grad",
                 digits=GRAD_DIGITS)


@register("grad_add_broadcast", S.with_(S.EMB)
          + f"SELECT 'row' AS bcase, CAST(j AS BIGINT) AS idx, {S.r('sum(x)', GRAD_DIGITS)} AS grad FROM emb GROUP BY j "
          f"UNION ALL SELECT 'col', row_id, {S.r('sum(x)', GRAD_DIGITS)} FROM emb GROUP BY row_id "
          f"UNION ALL SELECT 'scalar', CAST(0 AS BIGINT), {S.r('sum(x)', GRAD_DIGITS)} FROM emb")
def q_grad_add_broadcast(spark, d):
    rows = D.emb_rows(spark, d).select("row_id", F.col("vec").alias("g"))
    return _bcast_union(rows, negate=False)


def _bcast_union(rows, negate):
    r = grads.grad_add_broadcast(rows, "g", "row", negate=negate).select(
        F.lit("row").alias("bcase"), F.col("j").cast("bigint").alias("idx"), "grad")
    c = grads.grad_add_broadcast(rows, "g", "col", negate=negate).select(
        F.lit("col").alias("bcase"), F.col("row_id").alias("idx"), "grad")
    s = grads.grad_add_broadcast(rows, "g", "scalar", negate=negate).select(
        F.lit("scalar").alias("bcase"), F.lit(0).cast("bigint").alias("idx"), "grad")
    return r.unionByName(c).unionByName(s).select("bcase", "idx", C.tidy("grad", GRAD_DIGITS).alias("grad"))


@register("grad_sub", S.with_(S.EMB)
          + f"SELECT 'row' AS bcase, CAST(j AS BIGINT) AS idx, {S.r('-sum(x)', GRAD_DIGITS)} AS grad FROM emb GROUP BY j "
          f"UNION ALL SELECT 'col', row_id, {S.r('-sum(x)', GRAD_DIGITS)} FROM emb GROUP BY row_id "
          f"UNION ALL SELECT 'scalar', CAST(0 AS BIGINT), {S.r('-sum(x)', GRAD_DIGITS)} FROM emb")
def q_grad_sub(spark, d):
    rows = D.emb_rows(spark, d).select("row_id", F.col("vec").alias("g"))
    return _bcast_union(rows, negate=True)


@register("grad_mul", S.with_(S.LI, "lic AS (SELECT l_orderkey, l_linenumber, CAST(generate_subscripts(vec, 1) - 1 "
                                     "AS INTEGER) AS j, unnest(vec) AS a, unnest(list_reverse(vec)) AS b FROM li)")
          + f"SELECT l_orderkey, l_linenumber, j, {S.r('b * a', GRAD_DIGITS)} AS da, {S.r('a * a', GRAD_DIGITS)} AS db "
          "FROM lic")
def q_grad_mul(spark, d):
    """C = A * B with upstream G = A: dA = B*G, dB = A*G."""
    rows = D.li_rows(spark, d).select(*LI_KEYS, F.col("vec").alias("a"), F.reverse("vec").alias("b"))
    da, db = grads.grad_mul("a", "b", "a")
    ex = rows.select(*LI_KEYS, F.posexplode(F.arrays_zip(da.alias("da"), db.alias("db"))).alias("j", "s"))
    return ex.select(*LI_KEYS, "j", C.tidy(F.col("s")["da"], GRAD_DIGITS).alias("da"),
                     C.tidy(F.col("s")["db"], GRAD_DIGITS).alias("db"))


@register("grad_reduce", S.with_(S.EMB, "n AS (SELECT count(*) AS n FROM embeddings)")
          + f"SELECT 'sum' AS rule, row_id, j, 1.0 AS grad FROM emb UNION ALL "
          f"SELECT 'mean', row_id, j, {S.r('1.0 / (n * 64)', GRAD_DIGITS)} FROM emb CROSS JOIN n UNION ALL "
          f"SELECT 'mean0', row_id, j, {S.r('(((j*13) % 7 - 3) / 10.0) / n', GRAD_DIGITS)} "
          "FROM emb CROSS JOIN n UNION ALL "
          f"SELECT 'mean1', row_id, j, {S.r('label / 64.0', GRAD_DIGITS)} FROM emb")
def q_grad_reduce(spark, d):
    rows = D.emb_rows(spark, d)
    rows = rows.withColumn("n", D.table(spark, d, "embeddings").agg(F.count("*").cast("double")).scalar())
    over_n = lambda g: F.transform(g, lambda x: x / F.col("n"))
    parts = [
        ("sum", grads.grad_sum(1.0, "vec")),
        ("mean", over_n(grads.grad_mean_all(1.0, "vec", 64))),
        ("mean0", over_n(grads.grad_mean_axis0("vec", D.formula_b(64), 1))),
        ("mean1", grads.grad_mean_axis1("vec", F.col("label").cast("double"))),
    ]
    each = rows.select("row_id", F.explode(F.array(*[F.struct(F.lit(r).alias("rule"), e.alias("g")) for r, e in parts])).alias("r"))
    return cells(each.select("row_id", "r.rule", "r.g"), ["rule", "row_id"], "g", v="grad", digits=GRAD_DIGITS)


@register("grad_accumulate", S.with_(S.EMB) + f"SELECT row_id, j, {S.r('x + 2.0 * x', GRAD_DIGITS)} AS grad FROM emb")
def q_grad_accumulate(spark, d):
    base = D.emb_rows(spark, d).select("row_id", F.posexplode("vec").alias("j", "x"))  # two contributions, so two scans
    c1 = base.select("row_id", "j", F.col("x").alias("grad"))
    c2 = base.select("row_id", "j", (F.col("x") * 2.0).alias("grad"))
    return grads.grad_accumulate([c1, c2], ["row_id", "j"]).select("row_id", "j",
                                                                   C.tidy("grad", GRAD_DIGITS).alias("grad"))


# ================================================================ optimizers
@register("sgd_step", S.with_(*LIN_GRAD_CTES)
          + f"SELECT p.param_id, p.name, p.pos, {S.r('p.value - 0.1 * g.g', GRAD_DIGITS)} AS value "
          "FROM lparam p LEFT JOIN lgrad g USING (param_id, pos)")
def q_sgd_step(spark, d):
    out = optim.sgd_step(lin_param_table(spark), linear_ce_grad_cells(spark, d), lr=0.1)
    return out.select("param_id", "name", "pos", C.tidy("value", GRAD_DIGITS).alias("value"))


def _adam_sql(steps: int) -> str:
    ctes = list(LIN_GRAD_CTES)
    ctes.append("s0 AS (SELECT p.param_id, p.name, p.pos, p.value, 0.0 AS m, 0.0 AS v, g.g FROM lparam p "
                "LEFT JOIN lgrad g USING (param_id, pos))")
    for t in range(1, steps + 1):
        ctes.append(
            f"s{t} AS (SELECT param_id, name, pos, g, "
            f"value - 0.01 * ((0.9 * m + 0.1 * g) / (1 - power(0.9, {t}))) / "
            f"(sqrt((0.999 * v + 0.001 * g * g) / (1 - power(0.999, {t}))) + 1e-8) AS value, "
            f"0.9 * m + 0.1 * g AS m, 0.999 * v + 0.001 * g * g AS v FROM s{t - 1})")
    dg = GRAD_DIGITS
    return S.with_(*ctes) + (f"SELECT param_id, name, pos, {S.r('value', dg)} AS value, {S.r('m', dg)} AS m, "
                             f"{S.r('v', 14)} AS v FROM s{steps}")


def _adam_query(spark, d, steps: int) -> DataFrame:
    p = lin_param_table(spark)
    g = linear_ce_grad_cells(spark, d)
    for t in range(1, steps + 1):
        p = optim.adam_step(p, g, t=t, lr=0.01)
    return p.select("param_id", "name", "pos", C.tidy("value", GRAD_DIGITS).alias("value"),
                    C.tidy("m", GRAD_DIGITS).alias("m"), C.tidy("v", 14).alias("v"))


@register("adam_step", _adam_sql(1))
def q_adam_step(spark, d):
    return _adam_query(spark, d, 1)


@register("adam_two_steps", _adam_sql(2))
def q_adam_two_steps(spark, d):
    """Two steps with the same gradient table (t = 1, 2): exercises the bias corrections and moment carry."""
    return _adam_query(spark, d, 2)


@register("clip_by_norm", S.with_(*LIN_GRAD_CTES, "nm AS (SELECT param_id, sqrt(sum(g * g)) AS nrm FROM lgrad "
                                                   "GROUP BY param_id)")
          + f"SELECT param_id, pos, {S.r('CASE WHEN nrm > 0.01 THEN g * (0.01 / nrm) ELSE g END', GRAD_DIGITS)} "
          "AS grad FROM lgrad JOIN nm USING (param_id)")
def q_clip_by_norm(spark, d):
    out = optim.clip_by_norm(linear_ce_grad_cells(spark, d), 0.01)
    return out.select("param_id", "pos", C.tidy("grad", GRAD_DIGITS).alias("grad"))
