"""Losses as aggregates over row-layout predictions and targets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablegrad.functions.columns import arr_softmax, arr_sum, col, ln_ieee

LOG_EPS = 1e-12  # fixed value: added to probabilities before the log in cross entropy


def sq_err_sum(pred, target) -> Column:
    return arr_sum(F.zip_with(col(pred), col(target), lambda p, t: (p - t) * (p - t)))


def mse(df: DataFrame, pred: str = "pred", target: str = "target", out: str = "loss") -> DataFrame:
    """Mean over every element of (pred - target)^2."""
    s = df.agg(F.sum(sq_err_sum(pred, target)).alias("_s"), F.sum(F.size(pred)).alias("_n"))
    return s.select((F.col("_s") / F.col("_n")).alias(out))


def ce_row_sum(logits, target, inputs: str = "logits") -> Column:
    """Per row: sum_c -t_c * ln(softmax(logits)_c + eps)."""
    probs = arr_softmax(logits) if inputs == "logits" else arr_softmax(arr_softmax(logits))
    return arr_sum(F.zip_with(probs, col(target), lambda p, t: -t * ln_ieee(p + F.lit(LOG_EPS))))


def cross_entropy(df: DataFrame, logits: str = "logits", target: str = "target", reduction: str = "elements",
                  inputs: str = "logits", out: str = "loss") -> DataFrame:
    """Cross entropy with softmax; ``reduction='elements'`` divides by rows x classes (as the reference does),
    ``'batch'`` by rows. ``inputs='probabilities'`` applies softmax twice (the reference's MLP does)."""
    s = df.agg(F.sum(ce_row_sum(logits, target, inputs)).alias("_s"), F.count("*").alias("_m"),
               F.sum(F.size(logits)).alias("_n"))
    denom = F.col("_n") if reduction == "elements" else F.col("_m")
    return s.select((F.col("_s") / denom).alias(out))
