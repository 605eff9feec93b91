"""Tensor layouts and shape-changing operators.

Layout R: ``(row_id BIGINT, vec ARRAY<DOUBLE>)`` -- one row per leading index, the trailing axis in the array.
Layout C: ``(pos BIGINT, v DOUBLE)`` for any rank (row-major flat position), or ``(i, j, v)`` for matrices.

Shapes are Python tuples carried next to the DataFrame. All index arithmetic is column arithmetic, so reshape and
permute are projections: no shuffle, no driver round trip.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablegrad.functions.columns import col


def strides(shape: Sequence[int]) -> list[int]:
    out, acc = [], 1
    for d in reversed(shape):
        out.append(acc)
        acc *= d
    return list(reversed(out))


def numel(shape: Sequence[int]) -> int:
    n = 1
    for d in shape:
        n *= d
    return n


def resolve_shape(old: Sequence[int], new: Sequence[int]) -> tuple[int, ...]:
    """Fill a single -1 in ``new``; sizes must agree."""
    new = list(new)
    if sum(1 for d in new if d == -1) > 1:
        raise ValueError("reshape: at most one -1 is allowed")
    total = numel(old)
    if -1 in new:
        known = numel([d for d in new if d != -1])
        if known == 0 or total % known:
            raise ValueError(f"reshape: cannot infer -1 for {tuple(old)} -> {tuple(new)}")
        new[new.index(-1)] = total // known
    if numel(new) != total:
        raise ValueError(f"reshape: size mismatch {tuple(old)} -> {tuple(new)}")
    return tuple(new)


# ---------------------------------------------------------------- R <-> C
def rows_to_cells(df: DataFrame, id_col: str = "row_id", vec_col: str = "vec", keep: Sequence[str] = (),
                  j: str = "j", v: str = "v") -> DataFrame:
    """Explode each array into (id, j, v) cells (generate, no shuffle)."""
    return df.select(*[col(c) for c in [id_col, *keep]], F.posexplode(col(vec_col)).alias(j, v))


def cells_to_rows(cells: DataFrame, id_col: str = "row_id", j: str = "j", v: str = "v",
                  vec_col: str = "vec") -> DataFrame:
    """Regroup cells into arrays ordered by j. One group = one tensor row, bounded by the row width."""
    return (cells.groupBy(id_col)
            .agg(F.array_sort(F.collect_list(F.struct(F.col(j).alias("j"), F.col(v).alias("v")))).alias("_c"))
            .select(id_col, F.transform("_c", lambda s: s["v"]).alias(vec_col)))


def flat_cells(rows: DataFrame, width: int, id_col: str = "row_id", vec_col: str = "vec") -> DataFrame:
    """Flatten an R-layout matrix with dense row ids 0..m-1 into 1-D cells ``(pos, v)``."""
    return (rows.select(col(id_col).alias("_r"), F.posexplode(col(vec_col)).alias("_j", "v"))
            .select((F.col("_r") * F.lit(width) + F.col("_j")).cast("bigint").alias("pos"), "v"))


# ---------------------------------------------------------------- index arithmetic
def unravel(pos: str, shape: Sequence[int]) -> list[Column]:
    """Per-axis indices of a row-major position column (exact integer division)."""
    st = strides(shape)
    return [F.expr(f"(`{pos}` div {s}) % {d}").cast("bigint") for s, d in zip(st, shape)]


def ravel(idx: Sequence[Column], shape: Sequence[int]) -> Column:
    st = strides(shape)
    out = F.lit(0).cast("bigint")
    for c, s in zip(idx, st):
        out = out + c.cast("bigint") * F.lit(s)
    return out


def reshape_cells(cells: DataFrame, old_shape: Sequence[int], new_shape: Sequence[int],
                  pos: str = "pos", v: str = "v", index_prefix: str = "d") -> DataFrame:
    """Row-major reshape: position is unchanged, the new per-axis indices are derived by stride arithmetic."""
    new = resolve_shape(old_shape, new_shape)
    idx = unravel(pos, new)
    return cells.select(F.col(pos), *[c.alias(f"{index_prefix}{k}") for k, c in enumerate(idx)], F.col(v))


def permute_cells(cells: DataFrame, shape: Sequence[int], axes: Sequence[int] | None = None,
                  pos: str = "pos", v: str = "v") -> tuple[DataFrame, tuple[int, ...]]:
    """N-D axis permutation (default: reverse). Returns the new cells and the new shape."""
    nd = len(shape)
    axes = list(range(nd))[::-1] if axes is None else [a % nd for a in axes]
    if sorted(axes) != list(range(nd)):
        raise ValueError(f"permute: invalid axes {axes} for rank {nd}")
    new_shape = tuple(shape[a] for a in axes)
    idx = unravel(pos, shape)
    new_pos = ravel([idx[a] for a in axes], new_shape)
    return cells.select(new_pos.alias(pos), F.col(v)), new_shape


def inverse_axes(axes: Sequence[int]) -> list[int]:
    inv = [0] * len(axes)
    for k, a in enumerate(axes):
        inv[a] = k
    return inv


def checked(value: Column, condition: Column, message: str) -> Column:
    """``value``, failing the job where ``condition`` doesn't hold. The check is part of the value: it is made where that is used."""
    return F.when(F.assert_true(F.coalesce(condition, F.lit(False)), F.lit(message)).isNull(), value)


def guarded(df: DataFrame, condition: Column, message: str) -> DataFrame:
    """``df``, failing the job where ``condition`` doesn't hold, whichever columns are read and also when rows are only counted."""
    return df.where(checked(F.lit(True), condition, message))


def stack_rows(dfs: Sequence[DataFrame], rows_each: int, width: int, id_col: str = "row_id",
               vec_col: str = "vec") -> DataFrame:
    """Stack K tensors of shape [rows_each, width] (row ids 0..rows_each-1) along a new leading axis.

    Output row ``k * m + row_id`` keeps the source rank ``k``; no global ordering is needed. A row of another width or
    with an id outside the shape fails the job.
    """
    if not dfs:
        raise ValueError("stack: empty list")
    u = None
    for k, d in enumerate(dfs):
        inside = (col(id_col) >= 0) & (col(id_col) < rows_each)
        fits = guarded(guarded(d, inside, "stack: row id outside the shape"), F.size(vec_col) == width, "stack: shapes differ")
        p = fits.select(F.lit(k).cast("int").alias("rank"), (F.lit(k * rows_each).cast("bigint") + col(id_col)).alias(id_col), col(vec_col).alias(vec_col))
        u = p if u is None else u.unionByName(p)
    return u


def take_rows(rows: DataFrame, index: DataFrame, id_col: str = "row_id", out_col: str = "out_row",
              src_col: str = "src_row") -> DataFrame:
    """Gather rows by an index table ``(out_row, src_row)``; duplicates and order are kept.

    An index without a row fails the job. The join strategy is left to the optimizer.
    """
    idx = index.select(F.col(out_col).alias("_out"), F.col(src_col).alias("_src"))
    there = rows.withColumn("_there", F.lit(True))
    j = guarded(idx.join(there, F.col("_src") == there[id_col], "left"), F.col("_there"), "take_rows: index out of range")
    return j.select(F.col("_out").alias(id_col), *[c for c in rows.columns if c != id_col])


def shape_check(df: DataFrame, vec_col: str, expected: int, key_cols: Sequence[str]) -> DataFrame:
    """Rows whose tensor does not have ``expected`` elements, with the actual size."""
    return (df.select(*key_cols, F.size(vec_col).cast("int").alias("actual"))
            .where(F.col("actual") != expected)
            .withColumn("expected", F.lit(expected).cast("int")))
