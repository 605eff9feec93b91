"""Large matrices as tables of packed tiles, and their products by tile replication.

A matrix is a table ``(bi, bj, nr, nc, data)``: ``data`` has the tile's doubles, row by row. No cell is a row of its own in a
shuffle, and none is a Python object in a task.

``matmul`` cuts the output into regions of ``region`` x ``region`` tiles. The left tiles of a region's rows and the right tiles
of its columns are sent to it (so a left tile is replicated once per region along the columns, a right one along the rows),
keyed by region and by a salt, the range of ``span`` contraction blocks: a long contraction axis is spread over many tasks,
and no key stands for one contraction block with all its products. A task walks the contraction blocks in order and adds one
numpy product to the region's sum; the sums of the ranges are added in a second, output-sized shuffle. Memory of a task: the
region's sum and two stripes of tiles.

Shapes are checked: cells outside the shape, cells that are missing or there twice, and tiles that are missing fail the job.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablegrad.functions.arrow import column, list_to_matrix
from tablegrad.session import scratch_path

SIZE = 256
REGION = 4
SPAN = 64
SCHEMA = "bi bigint, bj bigint, nr int, nc int, data binary"
NAMES = ["bi", "bj", "nr", "nc", "data"]


@dataclass(frozen=True)
class Tiles:
    """An m x n matrix cut into tiles of ``size`` x ``size`` (smaller at the lower and right edges)."""
    df: DataFrame
    m: int
    n: int
    size: int = SIZE

    def blocks(self) -> tuple[int, int]:
        return math.ceil(self.m / self.size), math.ceil(self.n / self.size)

    def rows_of(self, b: int) -> int:
        return min(self.size, self.m - b * self.size)

    def cols_of(self, b: int) -> int:
        return min(self.size, self.n - b * self.size)

    def saved(self, folder: str | None = None) -> Tiles:
        """The tiles as a table in the shared folder (under ``folder``): what builds on them doesn't compute them again."""
        spark = self.df.sparkSession
        path = f"{folder or scratch_path(spark, 'tiles')}/{uuid.uuid4().hex}"
        self.df.write.parquet(path)
        return Tiles(spark.read.schema(self.df.schema).parquet(path), self.m, self.n, self.size)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    bi, bj, x = zip(*rows)
    return pa.RecordBatch.from_arrays(
        [pa.array(bi, pa.int64()), pa.array(bj, pa.int64()), pa.array([t.shape[0] for t in x], pa.int32()), pa.array([t.shape[1] for t in x], pa.int32()),
         pa.array([np.ascontiguousarray(t).tobytes() for t in x], pa.binary())], names=NAMES)


def _matrices(batch: pa.RecordBatch, data: str = "data") -> Iterator[np.ndarray]:
    for nr, nc, raw in zip(column(batch, "nr").to_pylist(), column(batch, "nc").to_pylist(), column(batch, data)):
        yield np.frombuffer(raw.as_buffer(), np.float64).reshape(nr, nc)


# ---------------------------------------------------------------- in and out
def from_cells(cells: DataFrame, m: int, n: int, size: int = SIZE, i: str = "i", j: str = "j", v: str = "v") -> Tiles:
    """Cells ``(i, j, v)`` of a dense matrix: one shuffle by tile, packed by numpy."""
    shape = Tiles(cells, m, n, size)

    def pack(key, held) -> tuple:
        bi, bj = key
        if not (0 <= bi < math.ceil(m / size) and 0 <= bj < math.ceil(n / size)):
            raise ValueError("tiles: a cell outside the shape")
        nr, nc = min(size, m - bi * size), min(size, n - bj * size)
        r, c, x = (np.concatenate(p) for p in zip(*held))
        if ((r < 0) | (r >= nr) | (c < 0) | (c >= nc)).any():
            raise ValueError("tiles: a cell outside the shape")
        at = r * nc + c
        if len(at) != nr * nc or (np.bincount(at, minlength=nr * nc) != 1).any():
            raise ValueError("tiles: a cell is missing or there twice")
        out = np.empty(nr * nc)
        out[at] = x
        return bi, bj, out.reshape(nr, nc)

    def kernel(batches):
        key, held = None, []
        for b in batches:
            bi, bj, r, c, x = (column(b, k).to_numpy(zero_copy_only=False) for k in ("bi", "bj", "r", "c", "v"))
            edges = np.flatnonzero((np.diff(bi) != 0) | (np.diff(bj) != 0)) + 1
            for s, e in zip([0, *edges.tolist()], [*edges.tolist(), len(bi)]):
                if s == e:
                    continue
                if key != (bi[s], bj[s]) and held:
                    yield _batch([pack(key, held)])
                    held = []
                key = int(bi[s]), int(bj[s])
                held.append((r[s:e], c[s:e], x[s:e].astype(np.float64)))
        if held:
            yield _batch([pack(key, held)])

    def div(x):
        return F.floor(F.col(x) / size).cast("bigint")
    keyed = cells.select(div(i).alias("bi"), div(j).alias("bj"), F.pmod(F.col(i), F.lit(size)).cast("int").alias("r"),
                         F.pmod(F.col(j), F.lit(size)).cast("int").alias("c"), F.col(v).cast("double").alias("v"))
    return Tiles(keyed.repartition("bi", "bj").sortWithinPartitions("bi", "bj").mapInArrow(kernel, SCHEMA), shape.m, shape.n, size)


def from_rows(rows: DataFrame, m: int, n: int, size: int = SIZE, id_col: str = "row_id", vec_col: str = "vec") -> Tiles:
    """Rows ``(id, array)`` with ids 0 to m - 1: one shuffle by block of rows."""
    def kernel(batches):
        ids, held = [], []

        def out(final: bool):
            """Tiles of the blocks of rows that are complete, or of all."""
            nonlocal ids, held
            at, x = np.concatenate(ids), np.concatenate(held)
            block = at // size
            cut = len(at) if final else int(np.flatnonzero(block == block[-1])[0])
            edges = np.flatnonzero(np.diff(block[:cut])) + 1
            for s, e in zip([0, *edges.tolist()], [*edges.tolist(), cut]):
                if s == e:
                    continue
                b = int(block[s])
                if b < 0 or b * size >= m or not np.array_equal(at[s:e], np.arange(b * size, min(m, (b + 1) * size))):
                    raise ValueError("tiles: a row is missing, there twice or outside the shape")
                yield _batch([(b, k, x[s:e, k * size:(k + 1) * size]) for k in range(math.ceil(n / size))])
            ids, held = [at[cut:]], [x[cut:]]

        for b in batches:
            if b.num_rows:
                ids.append(column(b, id_col).to_numpy(zero_copy_only=False).astype(np.int64))
                held.append(list_to_matrix(column(b, vec_col), n))
                yield from out(False)
        if sum(map(len, ids)):
            yield from out(True)

    keyed = rows.select(F.col(id_col), F.col(vec_col), F.floor(F.col(id_col) / size).alias("_b"))
    return Tiles(keyed.repartition("_b").sortWithinPartitions("_b", id_col).mapInArrow(kernel, SCHEMA), m, n, size)


def to_cells(x: Tiles, i: str = "i", j: str = "j", v: str = "v") -> DataFrame:
    size = x.size

    def kernel(batches):
        for b in batches:
            for bi, bj, t in zip(column(b, "bi").to_pylist(), column(b, "bj").to_pylist(), _matrices(b)):
                r, c = np.indices(t.shape)
                yield pa.RecordBatch.from_arrays([pa.array(bi * size + r.ravel()), pa.array(bj * size + c.ravel()), pa.array(t.ravel())], names=[i, j, v])

    return x.df.mapInArrow(kernel, f"{i} bigint, {j} bigint, {v} double")


# ---------------------------------------------------------------- tile by tile
def map_tiles(x: Tiles, fn: Callable[[np.ndarray], np.ndarray]) -> Tiles:
    """``fn`` of every tile (same shape), with no shuffle."""
    def kernel(batches):
        for b in batches:
            if b.num_rows:
                yield _batch([(bi, bj, fn(t)) for bi, bj, t in zip(column(b, "bi").to_pylist(), column(b, "bj").to_pylist(), _matrices(b))])

    return Tiles(x.df.mapInArrow(kernel, SCHEMA), x.m, x.n, x.size)


def combine(a: Tiles, b: Tiles, fn: Callable[[np.ndarray, np.ndarray], np.ndarray]) -> Tiles:
    """``fn`` of the tiles of two matrices of one shape, joined by place."""
    if (a.m, a.n, a.size) != (b.m, b.n, b.size):
        raise ValueError(f"tiles: {a.m} x {a.n} and {b.m} x {b.n} don't fit")

    def kernel(batches):
        for p in batches:
            if not p.num_rows:
                continue
            if column(p, "data").null_count or column(p, "other").null_count:
                raise ValueError("tiles: a tile is missing")
            yield _batch([(bi, bj, fn(x, y)) for bi, bj, x, y in zip(column(p, "bi").to_pylist(), column(p, "bj").to_pylist(), _matrices(p), _matrices(p, "other"))])

    both = a.df.join(b.df.select("bi", "bj", F.col("data").alias("other")), ["bi", "bj"], "full_outer")
    return Tiles(both.mapInArrow(kernel, SCHEMA), a.m, a.n, a.size)


def with_row(a: Tiles, row: Tiles, fn: Callable[[np.ndarray, np.ndarray], np.ndarray]) -> Tiles:
    """``fn`` of every tile and the tile of a 1 x n matrix under it."""
    if (row.m, row.n, row.size) != (1, a.n, a.size):
        raise ValueError("tiles: a row of the matrix's width is needed")

    def kernel(batches):
        for p in batches:
            if not p.num_rows:
                continue
            if column(p, "other").null_count:
                raise ValueError("tiles: a tile is missing")
            rows = (np.frombuffer(r.as_buffer(), np.float64)[None, :] for r in column(p, "other"))
            yield _batch([(bi, bj, fn(x, y)) for bi, bj, x, y in zip(column(p, "bi").to_pylist(), column(p, "bj").to_pylist(), _matrices(p), rows)])

    return Tiles(a.df.join(row.df.select("bj", F.col("data").alias("other")), "bj", "left").select(*NAMES, "other").mapInArrow(kernel, SCHEMA), a.m, a.n, a.size)


def _summed(parts: DataFrame, steps: int | None) -> DataFrame:
    """Tiles of one place added up; ``steps`` contraction blocks must have gone into each."""
    def kernel(batches):
        key, total, seen = None, None, 0

        def done():
            if steps is not None and seen != steps:
                raise ValueError("matmul: contraction sizes differ or a tile is missing")
            return _batch([(*key, total)])

        for b in batches:
            if not b.num_rows:
                continue
            for bi, bj, k, t in zip(column(b, "bi").to_pylist(), column(b, "bj").to_pylist(), column(b, "steps").to_pylist(), _matrices(b)):
                if key != (bi, bj):
                    if key is not None:
                        yield done()
                    key, total, seen = (bi, bj), np.zeros(t.shape), 0
                total = total + t
                seen += k
        if key is not None:
            yield done()

    return parts.repartition("bi", "bj").sortWithinPartitions("bi", "bj").mapInArrow(kernel, SCHEMA)


def column_sums(x: Tiles) -> Tiles:
    """1 x n: the sums over all rows. A task adds up its own tiles of a block of columns before the shuffle."""
    def kernel(batches):
        sums: dict[int, np.ndarray] = {}
        for b in batches:
            for bj, t in zip(column(b, "bj").to_pylist(), _matrices(b)):
                sums[bj] = sums.get(bj, 0.0) + t.sum(axis=0, keepdims=True)
        if sums:
            out = _batch([(0, bj, s) for bj, s in sums.items()])
            yield pa.RecordBatch.from_arrays([*out.columns, pa.array([0] * len(sums), pa.int32())], names=[*NAMES, "steps"])

    return Tiles(_summed(x.df.mapInArrow(kernel, SCHEMA + ", steps int"), None), 1, x.n, x.size)


# ---------------------------------------------------------------- products
def matmul(a: Tiles, b: Tiles, transpose_a: bool = False, transpose_b: bool = False, region: int = REGION, span: int = SPAN) -> Tiles:
    """A · B of two tiled matrices, either of them transposed on the way (its tiles are, when they are read)."""
    m, k = (a.n, a.m) if transpose_a else (a.m, a.n)
    k2, n = (b.n, b.m) if transpose_b else (b.m, b.n)
    if k != k2 or a.size != b.size:
        raise ValueError(f"matmul: {m} x {k} by {k2} x {n}, tiles of {a.size} and {b.size}")
    size = a.size
    blocks_m, blocks_k, blocks_n = (math.ceil(x / size) for x in (m, k, n))
    regions_i, regions_j = math.ceil(blocks_m / region), math.ceil(blocks_n / region)

    def side(x: Tiles, transposed: bool, left: bool) -> DataFrame:
        r, c = ("bj", "bi") if transposed else ("bi", "bj")
        outer, inner = (r, c) if left else (c, r)
        own, others = F.floor(F.col(outer) / region).cast("int"), F.explode(F.sequence(F.lit(0), F.lit((regions_j if left else regions_i) - 1)))
        keys = [own.alias("ri"), others.alias("rj")] if left else [others.alias("ri"), own.alias("rj")]
        return x.df.select(*keys, F.col(inner).alias("k"), F.lit(0 if left else 1).alias("side"), F.col(outer).alias("at"), "nr", "nc", "data")

    def kernel(batches):
        where, at_k, stripe, total, steps = None, None, ([], []), None, 0

        def product():
            nonlocal total, steps
            expected = [list(range(x * region, min(x * region + region, y))) for x, y in zip(where, (blocks_m, blocks_n))]
            if [[p for p, _ in s] for s in stripe] != expected or not 0 <= at_k < blocks_k:
                raise ValueError("matmul: contraction sizes differ or a tile is missing")
            x = np.vstack([t.T if transpose_a else t for _, t in stripe[0]]) @ np.hstack([t.T if transpose_b else t for _, t in stripe[1]])
            total = x if total is None else total + x
            steps += 1
            stripe[0].clear()
            stripe[1].clear()

        def out():
            ri, rj = where
            parts = [(ri * region + i, rj * region + j, total[i * size:(i + 1) * size, j * size:(j + 1) * size])
                     for i in range(math.ceil(total.shape[0] / size)) for j in range(math.ceil(total.shape[1] / size))]
            tiles = _batch(parts)
            return pa.RecordBatch.from_arrays([*tiles.columns, pa.array([steps] * len(parts), pa.int32())], names=[*NAMES, "steps"])

        for batch in batches:
            cols = [column(batch, c).to_pylist() for c in ("ri", "rj", "k", "side", "at")]
            for ri, rj, kk, s, at, t in zip(*cols, _matrices(batch)):
                if (ri, rj) != where or kk != at_k:
                    if where is not None:
                        product()
                    if where is not None and (ri, rj) != where:
                        yield out()
                        total, steps = None, 0
                    where, at_k = (ri, rj), kk
                stripe[s].append((at, t.copy()))
        if where is not None:
            product()
            yield out()

    both = side(a, transpose_a, True).unionByName(side(b, transpose_b, False)).withColumn("salt", F.floor(F.col("k") / span))
    dealt = both.repartition("ri", "rj", "salt").sortWithinPartitions("ri", "rj", "k", "side", "at").drop("salt")
    return Tiles(_summed(dealt.mapInArrow(kernel, SCHEMA + ", steps int"), blocks_k), m, n, size)


def grad_matmul(a: Tiles, b: Tiles, g: Tiles, **options) -> tuple[Tiles, Tiles]:
    """The gradients of A and B for C = A · B with upstream G: G · Bᵀ and Aᵀ · G."""
    return matmul(g, b, transpose_b=True, **options), matmul(a, g, transpose_a=True, **options)
