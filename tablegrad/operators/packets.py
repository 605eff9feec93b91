"""Tree reduction of gradient packets with a depth.

A packet is one task's sums, cut into blocks: ``(block, grad ARRAY<DOUBLE>, n)``. Before every shuffle a task adds up all packets
that it holds as numpy buffers, so each level ships one packet a task; the number of tasks falls by the same factor from level to
level, the depth-th root of the number of tasks. After the first level nothing depends on how many packets there were.
"""

from __future__ import annotations

import math

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablegrad.functions.arrow import column

SCHEMA = "task int, block int, grad array<double>, n bigint"


def _merge(df: DataFrame, ordered: bool) -> DataFrame:
    """One packet a task. ``ordered``: rows come block by block, so a task holds one block; else it holds a packet."""
    def kernel(batches):
        from pyspark import TaskContext
        task = TaskContext.get().partitionId()
        sums: dict[int, list] = {}

        def out():
            blocks = sorted(sums)
            rows = pa.RecordBatch.from_arrays(
                [pa.array([task] * len(blocks), pa.int32()), pa.array(blocks, pa.int32()), pa.array([sums[b][0] for b in blocks], pa.list_(pa.float64())),
                 pa.array([sums[b][1] for b in blocks], pa.int64())], names=["task", "block", "grad", "n"])
            sums.clear()
            return rows

        for batch in batches:
            grad = column(batch, "grad")
            values, at = grad.values.to_numpy(zero_copy_only=False), grad.offsets.to_numpy()
            for i, (block, n) in enumerate(zip(column(batch, "block").to_pylist(), column(batch, "n").to_pylist())):
                if ordered and sums and block not in sums:
                    yield out()
                own = values[at[i]:at[i + 1]]
                held = sums.get(block)
                if held is None:
                    sums[block] = [own.copy(), n]
                elif len(held[0]) != len(own):
                    raise ValueError("packets: blocks of one number differ in size")
                else:
                    held[0] += own
                    held[1] += n
        if sums:
            yield out()

    return df.mapInArrow(kernel, SCHEMA)


def fan_in(tasks: int, depth: int) -> int:
    """By how much the number of tasks falls at each of ``depth`` levels."""
    return max(2, math.ceil(tasks ** (1.0 / depth)))


def levels(tasks: int, depth: int) -> list[int]:
    """Numbers of tasks of the levels between the first packets and the sum."""
    if depth < 1:
        raise ValueError("tree reduce: a depth of 1 or more is needed")
    by, out = fan_in(tasks, depth), []
    for _ in range(depth - 1):
        tasks = math.ceil(tasks / by)
        if tasks <= 1:
            break
        out.append(tasks)
    return out


def tree_sum(packets: DataFrame, depth: int = 2, tasks: int | None = None) -> DataFrame:
    """``(block, grad, n)`` summed over all packets; ``tasks``: of the first level (shuffle partitions by default)."""
    n = tasks or int(packets.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    part = _merge(packets.select("block", "grad", "n"), False)
    for to in levels(n, depth):
        part = _merge(part.withColumn("_to", F.pmod("task", F.lit(to))).repartition(to, "_to").sortWithinPartitions("block"), True)
    return _merge(part.repartition("block").sortWithinPartitions("block"), True).select("block", "grad", "n")
