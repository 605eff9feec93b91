"""Partitions, mini-batches and shuffling as table operators.

``part = pmod(id, P)`` spreads unique ids evenly. Inside a partition, rows are numbered by id with a distributed
rank (range slices + per-slice offsets, see ``rank_within``), never a window holding a whole partition, and cut
into batches of B; the last batch of a partition may be short. A reproducible shuffle orders by
``shuffle_key(id, seed, epoch)``, an integer hash, instead of by id.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tablegrad.session import scratch_path


def assign_partition(df: DataFrame, id_col: str, num_partitions: int, part: str = "part") -> DataFrame:
    return df.withColumn(part, F.pmod(F.col(id_col), F.lit(num_partitions)).cast("int"))


def rank_within(df: DataFrame, part: str, order_cols, num_slices: int | None = None, out: str = "rank") -> DataFrame:
    """0-based rank of each row inside its ``part`` by ``order_cols``, without a window over a whole part.

    Rows are range-partitioned on ``(part, order)`` into ``num_slices`` slices (sampling picks the bounds, so a
    part holding a third of all rows is still cut into many slices). An Arrow kernel numbers rows inside each
    slice; per-(slice, part) counts -- a table of about ``num_slices + parts`` rows, so its size is bounded by the
    parameters, not the data -- give each slice's offset. Identical keys land in one slice.
    """
    import numpy as np
    import pyarrow as pa
    from pyspark.sql import types as T

    spark = df.sparkSession
    order_cols = [order_cols] if isinstance(order_cols, str) else list(order_cols)
    n = num_slices or max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)
    ranged = df.repartitionByRange(n, part, *order_cols).sortWithinPartitions(part, *order_cols)
    fields = list(df.schema.fields)
    schema = T.StructType(fields + [T.StructField("_slice", T.IntegerType()), T.StructField("_local", T.LongType())])

    def kernel(batches):
        from pyspark import TaskContext
        sid = TaskContext.get().partitionId()
        last, carry = None, 0
        for batch in batches:
            m = batch.num_rows
            if m == 0:
                continue
            pv = batch.column(batch.schema.get_field_index(part)).to_numpy(zero_copy_only=False)
            idx = np.arange(m)
            change = np.r_[True, pv[1:] != pv[:-1]]
            local = idx - np.maximum.accumulate(np.where(change, idx, 0))
            if last is not None and pv[0] == last:
                nxt = np.nonzero(change[1:])[0]
                end = int(nxt[0]) + 1 if len(nxt) else m
                local[:end] += carry
            last, carry = pv[-1], int(local[-1]) + 1
            yield pa.RecordBatch.from_arrays(
                list(batch.columns) + [pa.array(np.full(m, sid, dtype=np.int32)), pa.array(local.astype(np.int64))],
                names=[f.name for f in fields] + ["_slice", "_local"])

    # The slices are read twice (offsets, rows) and sampled bounds may differ between runs of a plan, so they are a
    # table in the shared folder: no cache to release, and a lost executor costs nothing.
    path = scratch_path(spark, f"ranked-{uuid.uuid4().hex}")
    ranged.mapInArrow(kernel, schema).write.parquet(path)
    ranked = spark.read.schema(schema).parquet(path)
    counts = ranked.groupBy("_slice", part).agg((F.max("_local") + 1).alias("_cnt"))
    offsets = counts.withColumn("_off", F.coalesce(F.sum("_cnt").over(
        Window.partitionBy(part).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    offsets = offsets.select("_slice", part, "_off")
    ranked_out = (ranked.join(offsets, ["_slice", part])
                  .withColumn(out, (F.col("_off") + F.col("_local")).cast("bigint"))
                  .drop("_slice", "_local", "_off"))
    ranked_out._tablegrad_counts = counts
    return ranked_out


def shuffle_key(ids, seed: int, epoch: int):
    """A reproducible order: integer ids by modular arithmetic that any engine repeats."""
    m, x = 2147483647, F.lit((seed * 1000003 + epoch) % 2147483647).cast("bigint")
    for c in ids:
        x = ((x + F.pmod(F.col(c).cast("bigint"), F.lit(m)) + 1) * 48271) % m
        x = (x * 69621 + 12345) % m
    return x


def assign_batches(df: DataFrame, id_col, num_partitions: int, batch_size: int, shuffle_seed: int | None = None,
                   epoch: int = 0, part: str = "part", num_slices: int | None = None) -> DataFrame:
    """Adds ``part``, ``batch_id``, ``bsize`` (rows in this batch), ``nbatches`` (batches in this part) and
    ``row_in_part``. ``id_col`` may be one column or a list (a total order; equal keys are interchangeable)."""
    ids = [id_col] if isinstance(id_col, str) else list(id_col)
    if part not in df.columns:
        df = assign_partition(df, ids[0], num_partitions, part)
    if shuffle_seed is not None:
        df = df.withColumn("_shuffle", shuffle_key(ids, shuffle_seed, epoch))
        order = ["_shuffle", *ids]
    else:
        order = ids
    ranked = rank_within(df, part, order, num_slices, out="row_in_part")
    # rows per part from the small per-(slice, part) count table, not from another pass over the data
    counts = ranked._tablegrad_counts
    sizes = counts.groupBy(part).agg(F.sum("_cnt").alias("_n"))
    out = ranked.join(sizes, part).withColumn("batch_id", F.floor(F.col("row_in_part") / batch_size).cast("bigint"))
    full = F.floor(F.col("_n") / batch_size)
    out = (out.withColumn("nbatches", F.ceil(F.col("_n") / batch_size).cast("bigint"))
           .withColumn("bsize", F.when(F.col("batch_id") < full, F.lit(batch_size))
                       .otherwise(F.col("_n") - full * batch_size).cast("int"))
           .drop("_n"))
    return out.drop("_shuffle") if shuffle_seed is not None else out


def minibatch_stack(batched: DataFrame, id_col: str, features: str, target: str | None = None,
                    part: str = "part") -> DataFrame:
    """One row per (part, batch): features (and targets) stacked in row order. A batch holds at most B rows."""
    items = [F.col(id_col).alias("id"), F.col(features).alias("x")] + ([F.col(target).alias("y")] if target else [])
    g = batched.groupBy(part, "batch_id").agg(F.array_sort(F.collect_list(F.struct(*items))).alias("_s"))
    cols = [part, "batch_id", F.size("_s").cast("int").alias("rows"),
            F.transform("_s", lambda s: s["id"]).alias("ids"), F.transform("_s", lambda s: s["x"]).alias("features")]
    if target:
        cols.append(F.transform("_s", lambda s: s["y"]).alias("targets"))
    return g.select(*cols)


def num_batches(df: DataFrame, id_col: str, num_partitions: int, batch_size: int, part: str = "part") -> DataFrame:
    """ceil(n / B) per partition, from counts alone (no window)."""
    return (assign_partition(df, id_col, num_partitions, part).groupBy(part)
            .agg(F.count("*").alias("n"))
            .select(part, "n", F.ceil(F.col("n") / batch_size).cast("int").alias("batches")))


def partition_balance(df: DataFrame, id_col: str, num_partitions: int, part: str = "part") -> DataFrame:
    """Rows per partition under ``pmod(id, P)`` (the deterministic stand-in for round-robin repartition)."""
    return assign_partition(df, id_col, num_partitions, part).groupBy(part).agg(F.count("*").alias("n"))


# ---------------------------------------------------------------- shuffling without a sort
_M = 2147483647  # a prime; all products of two residues fit in 64 bits
FEISTEL_ROUNDS = 4
#: Steps of a cycle walk that a plan holds. A walk passes places from n to a * b - 1 alone, fewer than sqrt(n) + 1.
WALKS = 64


def _keys(seed: int, epoch: int) -> list[int]:
    x = (seed * 1000003 + epoch) % _M
    out = []
    for _ in range(FEISTEL_ROUNDS):
        x = (x * 48271 + 12345) % _M
        out.append(x)
    return out


def _feistel(x, a: int, b: int, keys: list[int]):
    """One pass of a keyed bijection on 0 to a * b - 1: the halves x div b and x mod b are shifted in turn by a hash of the other."""
    left, right = F.floor(x / b), x % b  # exact: places are far below 2**53
    for i, key in enumerate(keys):
        y = ((right if i % 2 == 0 else left) + key) % _M
        shift = (y * y % _M * 69621 + key) % _M  # the square keeps equal steps of one half from staying equal steps
        if i % 2 == 0:
            left = (left + shift) % a
        else:
            right = (right + shift) % b
    return (left * b + right).cast("bigint")


def shuffle_permutation(rank, n: int, seed: int, epoch: int = 0):
    """The place of each of the dense ranks 0 to ``n`` - 1 in a keyed permutation, by arithmetic alone: no sort, no shuffle.

    Feistel rounds permute a domain of a * b places with a = ceil(sqrt(n)), fewer than a more than there are ranks; a place
    outside 0 to n - 1 goes through them again (cycle walking), which keeps the map a bijection. A rank outside 0 to n - 1
    fails the job.
    """
    from math import ceil, isqrt

    from tablegrad.operators.layout import checked
    if not 0 <= n < 1 << 46:
        raise ValueError("shuffle: between 0 and 2**46 rows")
    a = max(1, isqrt(max(n - 1, 0)) + 1)
    b, keys = max(1, ceil(n / a)), _keys(seed, epoch)
    rank = F.col(rank) if isinstance(rank, str) else rank
    first = _feistel(checked(rank.cast("bigint"), (rank >= 0) & (rank < n), "shuffle: a rank is outside the table"), a, b, keys)
    if a * b == n:
        return first
    walk = F.aggregate(F.sequence(F.lit(1), F.lit(WALKS)), first, lambda x, _: F.when(x < n, x).otherwise(_feistel(x, a, b, keys)))
    return checked(walk, walk < n, "shuffle: a cycle walk didn't end")


def shuffled_batches(df: DataFrame, rank_col: str, n: int, num_partitions: int, batch_size: int, seed: int, epoch: int = 0) -> DataFrame:
    """``df`` with dense ranks 0 to ``n`` - 1 as shuffled mini-batches: adds ``part``, ``row_in_part``, ``batch_id``, ``bsize`` and ``nbatches``.

    A row's place says all of it: its part is the place modulo P, its number there the quotient. The plan is one projection.
    """
    place = shuffle_permutation(rank_col, n, seed, epoch)
    rows = df.withColumn("_place", place).withColumn("part", (F.col("_place") % num_partitions).cast("int")) \
        .withColumn("row_in_part", F.floor(F.col("_place") / num_partitions).cast("bigint")).drop("_place")
    size = F.floor((F.lit(n) - 1 - F.col("part")) / num_partitions) + 1
    batch = F.floor(F.col("row_in_part") / batch_size).cast("bigint")
    return rows.withColumns({"batch_id": batch, "bsize": F.least(F.lit(batch_size), size - batch * batch_size).cast("int"),
                             "nbatches": F.ceil(size / batch_size).cast("bigint")})
