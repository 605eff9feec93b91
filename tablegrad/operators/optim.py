"""Optimizers and gradient clipping, as parameter-table plans and as driver-side numpy steps.

Table form: parameters ``(param_id, name, pos, value[, m, v])`` left-joined with gradients ``(param_id, pos,
grad)`` on the key; a parameter without a gradient keeps value, m and v. The driver form is used by the
training loop, where parameters are model-sized numpy arrays.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ADAM_DEFAULTS = dict(lr=0.001, beta1=0.9, beta2=0.999, eps=1e-8)


def _join_grads(params: DataFrame, grads: DataFrame) -> DataFrame:
    return params.join(grads.select("param_id", "pos", "grad"), ["param_id", "pos"], "left")


def sgd_step(params: DataFrame, grads: DataFrame, lr: float) -> DataFrame:
    """theta <- theta - lr * g; missing gradients leave the parameter unchanged."""
    j = _join_grads(params, grads)
    return j.select("param_id", "name", "pos",
                    (F.col("value") - F.lit(lr) * F.coalesce(F.col("grad"), F.lit(0.0))).alias("value"))


def adam_step(params: DataFrame, grads: DataFrame, t: int, lr: float = 0.001, beta1: float = 0.9,
              beta2: float = 0.999, eps: float = 1e-8) -> DataFrame:
    """One bias-corrected Adam step at global step ``t`` (1-based). Moments default to 0 when absent."""
    p = params
    if "m" not in p.columns:
        p = p.withColumn("m", F.lit(0.0))
    if "v" not in p.columns:
        p = p.withColumn("v", F.lit(0.0))
    j = _join_grads(p, grads)
    g = F.col("grad")
    m_new = F.lit(beta1) * F.col("m") + F.lit(1 - beta1) * g
    v_new = F.lit(beta2) * F.col("v") + F.lit(1 - beta2) * g * g
    m_hat = m_new / F.lit(1 - beta1 ** t)
    v_hat = v_new / F.lit(1 - beta2 ** t)
    has = g.isNotNull()
    return j.select("param_id", "name", "pos",
                    F.when(has, F.col("value") - F.lit(lr) * m_hat / (F.sqrt(v_hat) + F.lit(eps)))
                    .otherwise(F.col("value")).alias("value"),
                    F.when(has, m_new).otherwise(F.col("m")).alias("m"),
                    F.when(has, v_new).otherwise(F.col("v")).alias("v"))


def clip_by_norm(grads: DataFrame, max_norm: float, key: str = "param_id", g: str = "grad") -> DataFrame:
    """Per parameter tensor: rescale by max_norm / ||g|| when the L2 norm exceeds max_norm.

    The norms are one row per parameter tensor, joined back.
    """
    norms = grads.groupBy(key).agg(F.sqrt(F.sum(F.col(g) * F.col(g))).alias("_norm"))
    scale = F.when(F.col("_norm") > F.lit(max_norm), F.lit(max_norm) / F.col("_norm")).otherwise(F.lit(1.0))
    return (grads.join(norms, key)
            .withColumn(g, F.col(g) * scale).drop("_norm"))


def iterate_table_steps(params: DataFrame, grad_fn, steps: int, optimizer: str = "sgd", lr: float = 0.01,
                        checkpoint_every: int = 5, **adam_kw) -> DataFrame:
    """Run ``steps`` optimizer updates on a table-resident parameter set.

    ``grad_fn(params) -> (param_id, pos, grad)`` builds the gradient plan at the current parameters. Each step
    stacks another join onto the lineage, so every ``checkpoint_every`` steps the table is written with
    ``checkpoint()`` to the shared ``spark.checkpoint.dir`` (reliable storage: a lost executor does not lose it).
    """
    from tablegrad.session import ensure_checkpoint_dir
    if optimizer not in ("sgd", "adam"):
        raise ValueError(f"unknown optimizer {optimizer}")
    ensure_checkpoint_dir(params.sparkSession)
    p = params
    for t in range(1, steps + 1):
        g = grad_fn(p)
        p = sgd_step(p, g, lr) if optimizer == "sgd" else adam_step(p, g, t, lr=lr, **adam_kw)
        if checkpoint_every and t % checkpoint_every == 0:
            p = p.checkpoint(eager=True)
    return p


# ---------------------------------------------------------------- driver-side (model-sized numpy)
class SGD:
    def __init__(self, lr: float):
        self.lr = lr

    def step(self, params: list[np.ndarray], grads: list[np.ndarray]) -> list[np.ndarray]:
        return [p - self.lr * g for p, g in zip(params, grads)]


class Adam:
    def __init__(self, lr: float = 0.001, beta1: float = 0.9, beta2: float = 0.999, eps: float = 1e-8):
        self.lr, self.beta1, self.beta2, self.eps = lr, beta1, beta2, eps
        self.t = 0
        self.m = self.v = None

    def step(self, params: list[np.ndarray], grads: list[np.ndarray]) -> list[np.ndarray]:
        self.t += 1
        if self.m is None:
            self.m = [np.zeros_like(p) for p in params]
            self.v = [np.zeros_like(p) for p in params]
        out = []
        for k, (p, g) in enumerate(zip(params, grads)):
            self.m[k] = self.beta1 * self.m[k] + (1 - self.beta1) * g
            self.v[k] = self.beta2 * self.v[k] + (1 - self.beta2) * g * g
            m_hat = self.m[k] / (1 - self.beta1 ** self.t)
            v_hat = self.v[k] / (1 - self.beta2 ** self.t)
            out.append(p - self.lr * m_hat / (np.sqrt(v_hat) + self.eps))
        return out


def clip_np(grads: list[np.ndarray], max_norm: float) -> list[np.ndarray]:
    out = []
    for g in grads:
        n = float(np.sqrt((g * g).sum()))
        out.append(g * (max_norm / n) if n > max_norm else g)
    return out
