"""Registered queries over the given tables, each paired with an equivalent DuckDB oracle where SQL can say it.

Every query reads whole tables (no id subsets or caps). Tensor results are returned as cells with scalar
columns; doubles are rounded (6 decimals, 10 for gradients) and -0.0 folded, in both engines.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablegrad.functions import columns as C
from tablegrad.operators import activations, elementwise, linalg, losses, reduce
from tablegrad.plans import data as D
from tablegrad.plans import sqlparts as S

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return deco


def cells(df: DataFrame, keys, arr, j: str = "j", v: str = "v", digits: int = 6) -> DataFrame:
    """Explode an array result into (keys, j, v) with the comparison rounding applied."""
    ex = df.select(*keys, F.posexplode(C.col(arr)).alias(j, "_v"))
    return ex.select(*keys, j, C.tidy("_v", digits).alias(v))


LI_KEYS = ["l_orderkey", "l_linenumber"]


# ============================================================== activations and losses (the minimum slice)
@register("act_softmax", S.with_(
    S.EMB,
    "m AS (SELECT row_id, max(x) AS mx FROM emb GROUP BY row_id)",
    "e AS (SELECT emb.row_id, j, exp(x - mx) AS ex FROM emb JOIN m USING (row_id))",
    "s AS (SELECT row_id, sum(ex) AS se FROM e GROUP BY row_id)")
    + f"SELECT row_id, j, {S.r('ex / se')} AS p FROM e JOIN s USING (row_id)")
def q_act_softmax(spark, d):
    return cells(D.emb_rows(spark, d).select("row_id", activations.softmax_last("vec").alias("p")),
                 ["row_id"], "p", v="p")


@register("act_softmax_axis0", S.with_(
    S.EMB,
    "m AS (SELECT j, max(x) AS mx FROM emb GROUP BY j)",
    "e AS (SELECT emb.row_id, j, exp(x - mx) AS ex FROM emb JOIN m USING (j))",
    "s AS (SELECT j, sum(ex) AS se FROM e GROUP BY j)")
    + f"SELECT row_id, j, {S.r('ex / se')} AS p FROM e JOIN s USING (j)")
def q_act_softmax_axis0(spark, d):
    rows = D.emb_rows(spark, d)
    n = rows.count()
    flat = rows.select(F.posexplode("vec").alias("j", "v"), "row_id").select(
        (F.col("row_id") * D.EMB_DIM + F.col("j")).alias("pos"), "v")
    sm = activations.softmax_cells(flat, (n, D.EMB_DIM), axis=0)
    return sm.select(F.expr(f"pos div {D.EMB_DIM}").cast("bigint").alias("row_id"),
                     (F.col("pos") % D.EMB_DIM).cast("int").alias("j"), C.tidy("p").alias("p"))


@register("act_relu", S.with_(S.EMB)
          + f"SELECT row_id, j, {S.r('CASE WHEN x > 0 THEN x ELSE 0.0 END')} AS v FROM emb")
def q_act_relu(spark, d):
    return cells(D.emb_rows(spark, d).select("row_id", activations.act_relu("vec").alias("y")), ["row_id"], "y")


@register("act_sigmoid", S.with_(S.EMB) + f"SELECT row_id, j, {S.r('1.0 / (1.0 + exp(-x))')} AS v FROM emb")
def q_act_sigmoid(spark, d):
    return cells(D.emb_rows(spark, d).select("row_id", activations.act_sigmoid("vec").alias("y")), ["row_id"], "y")


LOGITS_SQL = [
    S.EMB, S.weights("w", 64, 10), S.bias("b", 10),
    "lg AS (SELECT emb.row_id, w.j AS c, sum(emb.x * w.w) AS z0 FROM emb JOIN w ON emb.j = w.k "
    "GROUP BY emb.row_id, w.j)",
    "lg2 AS (SELECT lg.row_id, lg.c, lg.z0 + b.b AS z FROM lg JOIN b ON lg.c = b.j)",
]
SOFTMAX_LOGITS_SQL = LOGITS_SQL + [
    "mz AS (SELECT row_id, max(z) AS m FROM lg2 GROUP BY row_id)",
    "ez AS (SELECT lg2.row_id, c, exp(z - m) AS e FROM lg2 JOIN mz USING (row_id))",
    "sz AS (SELECT row_id, sum(e) AS s FROM ez GROUP BY row_id)",
    "pr AS (SELECT ez.row_id, c, e / s AS p FROM ez JOIN sz USING (row_id))",
    "lab AS (SELECT vec_id AS row_id, label FROM embeddings)",
]


def emb_logits(spark, d) -> DataFrame:
    return D.emb_rows(spark, d).select(
        "row_id", "label", "vec", C.vec_matmul("vec", D.formula_w(64, 10), D.formula_b(10)).alias("logits"))


@register("loss_cross_entropy", S.with_(*SOFTMAX_LOGITS_SQL)
          + "SELECT " + S.r("sum(-(CASE WHEN pr.c = lab.label THEN 1.0 ELSE 0.0 END) * ln(pr.p + 1e-12)) "
                            "/ count(*)") + " AS loss FROM pr JOIN lab USING (row_id)")
def q_loss_cross_entropy(spark, d):
    df = emb_logits(spark, d).select("logits", C.one_hot("label", D.N_CLASSES).alias("target"))
    return losses.cross_entropy(df, "logits", "target").select(C.tidy("loss").alias("loss"))


def _li_pred_sql() -> str:
    f = ["l_quantity / 50.0", "l_discount * 10.0", "l_tax * 10.0"]
    return " + ".join(f"({x}) * {S.w_expr(k, 0)}" for k, x in enumerate(f)) + f" + {S.b_expr(0)}"


@register("loss_mse", f"SELECT {S.r(f'avg(power(({_li_pred_sql()}) - l_extendedprice / 100000.0, 2))')} AS loss "
          "FROM lineitem")
def q_loss_mse(spark, d):
    df = D.li_regression(spark, d).select(C.vec_matmul("features", D.formula_w(3, 1), D.formula_b(1)).alias("pred"),
                                          "target")
    return losses.mse(df, "pred", "target").select(C.tidy("loss").alias("loss"))


# ============================================================== linear algebra
@register("matmul_mm", S.with_(S.EMB, S.weights("w", 64, 16))
          + f"SELECT emb.row_id, w.j, {S.r('sum(emb.x * w.w)')} AS v FROM emb JOIN w ON emb.j = w.k "
          "GROUP BY emb.row_id, w.j")
def q_matmul_mm(spark, d):
    out = linalg.rows_times_small(D.emb_rows(spark, d), D.formula_w(64, 16), vec_col="vec", out_col="y",
                                  keep=["row_id"])
    return cells(out, ["row_id"], "y")


@register("matmul_mv", S.with_(S.EMB, S.weights("w", 64, 1))
          + f"SELECT emb.row_id, {S.r('sum(emb.x * w.w)')} AS v FROM emb JOIN w ON emb.j = w.k GROUP BY emb.row_id")
def q_matmul_mv(spark, d):
    w = D.formula_w(64, 1)[:, 0]
    return D.emb_rows(spark, d).select("row_id", C.tidy(linalg.matvec("vec", w)).alias("v"))


def weight_cells(spark, k: int, n: int, salt: int = 0) -> DataFrame:
    """The formula weight matrix generated as a (k, j, v) table by Spark itself."""
    return spark.range(k * n).select(
        (F.col("id") / n).cast("int").alias("k"), (F.col("id") % n).cast("int").alias("j")).select(
        "k", "j", (((F.col("k") * 37 + F.col("j") * 17 + salt) % 101 - 50) / F.lit(500.0)).alias("v"))


@register("matmul_vm", S.with_(S.EMB, S.weights("w", 64, 16),
                               "cs AS (SELECT j AS k, sum(x) AS x FROM emb GROUP BY j)")
          + f"SELECT w.j, {S.r('sum(cs.x * w.w)')} AS v FROM cs JOIN w USING (k) GROUP BY w.j")
def q_matmul_vm(spark, d):
    colsum = reduce.sum_axis0(D.emb_rows(spark, d), out="x").withColumnRenamed("j", "k")
    out = linalg.vec_mat(colsum, weight_cells(spark, 64, 16), x="x", out="v")
    return out.select("j", C.tidy("v").alias("v"))


@register("matmul_dot", S.with_(S.EMB, S.weights("w", 64, 1),
                                "cs AS (SELECT j AS k, sum(x) AS x FROM emb GROUP BY j)")
          + f"SELECT {S.r('sum(cs.x * w.w)')} AS dot FROM cs JOIN w USING (k)")
def q_matmul_dot(spark, d):
    colsum = reduce.sum_axis0(D.emb_rows(spark, d), out="x").withColumnRenamed("j", "k")
    w = weight_cells(spark, 64, 1).select("k", F.col("v").alias("y"))
    return linalg.dot(colsum, w).select(C.tidy("dot").alias("dot"))


@register("l2_norm", S.with_(S.LI, S.LIC) + f"SELECT {S.r('sqrt(sum(x * x))')} AS l2 FROM lic")
def q_l2_norm(spark, d):
    return reduce.l2_norm(D.li_rows(spark, d)).select(C.tidy("l2").alias("l2"))


# ============================================================== reductions
@register("sum_all", S.with_(S.LI, S.LIC) + f"SELECT {S.r('coalesce(sum(x), 0.0)')} AS total FROM lic")
def q_sum_all(spark, d):
    return reduce.sum_all(D.li_rows(spark, d)).select(C.tidy("total").alias("total"))


@register("mean_all", S.with_(S.LI, S.LIC) + f"SELECT {S.r('avg(x)')} AS mean FROM lic")
def q_mean_all(spark, d):
    return reduce.mean_all(D.li_rows(spark, d)).select(C.tidy("mean").alias("mean"))


@register("mean_axis0", S.with_(S.LI, S.LIC) + f"SELECT j, {S.r('avg(x)')} AS mean FROM lic GROUP BY j")
def q_mean_axis0(spark, d):
    return reduce.mean_axis0(D.li_rows(spark, d)).select("j", C.tidy("mean").alias("mean"))


@register("mean_axis1", S.with_(S.LI) + f"SELECT l_orderkey, l_linenumber, {S.r('list_avg(vec)')} AS mean FROM li")
def q_mean_axis1(spark, d):
    return D.li_rows(spark, d).select(*LI_KEYS, C.tidy(reduce.mean_axis1("vec")).alias("mean"))


# ============================================================== elementwise
def _li_ew(spark, d, expr) -> DataFrame:
    return cells(D.li_rows(spark, d).select(*LI_KEYS, expr.alias("y")), LI_KEYS, "y")


def _li_ew_sql(expr: str, with_rev: bool = False) -> str:
    ctes = [S.LI, "lic AS (SELECT l_orderkey, l_linenumber, CAST(generate_subscripts(vec, 1) - 1 AS INTEGER) AS j, "
                  "unnest(vec) AS x, unnest(list_reverse(vec)) AS y FROM li)"]
    return S.with_(*ctes) + f"SELECT l_orderkey, l_linenumber, j, {S.r(expr)} AS v FROM lic"


def _row_vec_sql() -> str:
    return "(j + 1) / 4.0"


@register("ew_add", _li_ew_sql("x + y"))
def q_ew_add(spark, d):
    return _li_ew(spark, d, elementwise.ew_binary("vec", F.reverse("vec"), "add"))


@register("ew_sub", _li_ew_sql("x - y"))
def q_ew_sub(spark, d):
    return _li_ew(spark, d, elementwise.ew_binary("vec", F.reverse("vec"), "sub"))


@register("ew_mul", _li_ew_sql("x * y"))
def q_ew_mul(spark, d):
    return _li_ew(spark, d, elementwise.ew_binary("vec", F.reverse("vec"), "mul"))


@register("ew_add_row_broadcast", _li_ew_sql(f"x + {_row_vec_sql()}"))
def q_ew_add_row_broadcast(spark, d):
    return _li_ew(spark, d, elementwise.row_broadcast("vec", D.ROW_VEC_4, "add"))


@register("ew_mul_row_broadcast", _li_ew_sql(f"x * {_row_vec_sql()}"))
def q_ew_mul_row_broadcast(spark, d):
    return _li_ew(spark, d, elementwise.row_broadcast("vec", D.ROW_VEC_4, "mul"))


@register("ew_sub_col_broadcast", S.with_(S.EMB, "c AS (SELECT vec_id AS row_id, label / 10.0 AS c FROM embeddings)")
          + f"SELECT row_id, j, {S.r('x - c')} AS v FROM emb JOIN c USING (row_id)")
def q_ew_sub_col_broadcast(spark, d):
    rows = D.emb_rows(spark, d).select("row_id", "vec")
    colvec = D.table(spark, d, "embeddings").select(F.col("vec_id").alias("row_id"),
                                                    (F.col("label") / F.lit(10.0)).alias("c"))
    out = elementwise.col_broadcast(rows, colvec, "sub", out_col="y")
    return cells(out, ["row_id"], "y")


@register("ew_neg", _li_ew_sql("-x"))
def q_ew_neg(spark, d):
    return _li_ew(spark, d, elementwise.ew_unary("vec", "neg"))


@register("ew_pow", _li_ew_sql("power(x, 1.5)"))
def q_ew_pow(spark, d):
    return _li_ew(spark, d, elementwise.ew_unary("vec", "pow", 1.5))


@register("ew_sqrt", _li_ew_sql("sqrt(x)"))
def q_ew_sqrt(spark, d):
    return _li_ew(spark, d, elementwise.ew_unary("vec", "sqrt"))


@register("ew_reciprocal", _li_ew_sql("CASE WHEN x = 0 THEN 'Infinity'::DOUBLE ELSE 1.0 / x END"))
def q_ew_reciprocal(spark, d):
    return _li_ew(spark, d, elementwise.ew_unary("vec", "reciprocal"))


@register("ew_log", _li_ew_sql("CASE WHEN x = 0 THEN '-Infinity'::DOUBLE ELSE ln(x) END"))
def q_ew_log(spark, d):
    return _li_ew(spark, d, elementwise.ew_unary("vec", "log"))


@register("fill_like", _li_ew_sql("0.0 * x + 0.5"))
def q_fill_like(spark, d):
    return _li_ew(spark, d, elementwise.fill_like("vec", 0.5))


from tablegrad.plans import catalog_graph, catalog_io, catalog_more, catalog_train  # noqa: E402,F401  (register the remaining queries)


def flagship(spark: SparkSession, d: str) -> DataFrame:
    """The entry query; replaced by MLP training once the training plan is registered."""
    return catalog_train.train_mlp_history(spark, d, epochs=2)
