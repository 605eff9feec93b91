"""Hard negatives by exact inner-product search over lists that anchors of one cluster share.

Anchors are clustered by direction. For a cluster with centre c and widest member angle b, the inner product of any member
a with a row i is at most |a| |i| cos(max(0, angle(i, c) - b)): the rows are sorted by that bound once, and every member walks
the same list, a block of rows at a time, until the bound at its place proves that nothing further can enter its results.

All rows are dealt by hash into groups of bounded size; a task holds one group and meets the blocks of clustered anchors one
after another (anchors are the stated query set; every block goes to every group). Two walks: the first finds the most
similar rows of an anchor's own label (positives), the second the rows of other labels in the window under each positive.
A group returns at most as many rows as are asked for, and one window over these gives the final ones. Scores are integers
and exact: products are summed in single precision where no partial sum can pass 2**24, in double where none can pass
2**53, and in 64-bit integers otherwise. Only the k-means centres are fitted on a bounded sample (``SAMPLE`` anchors); they
decide how early a walk ends, never what it finds.

Defined results: rows with a null label or vector, or with a null or non-finite component, take no part; a null id is no
anchor and comes after all others in ties; shorter vectors count as filled up with zeros; a quantised component beyond
+-(2**31 - 1) counts as that; repeated rows are rows of their own, so a copy of an anchor is one of its positives; among rows
of equal score and id the order is that of an arbitrary row number. An empty table, no anchors, or anchors without positives
give no rows. Columns of other names are never read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as ty

from .common import checkpointed, column, ints

POSITIVES = NEGATIVES = 5
SCALE = 256
#: Anchors that teach the cluster centres, chosen by hash, and most centres.
SAMPLE = 4096
CENTRES = 256
#: Anchors of one block, and about how many of one cluster where there are few.
MEMBERS = 512
PER_CENTRE = 32
#: Components that a task holds at once (4 or 8 bytes each).
GROUP_VALUES = 8 << 20
STEP = 2048
NONE = np.iinfo(np.int64).min


def quantised(rows: DataFrame, anchor: Column, id_col: str, label_col: str, vec_col: str, scale: int) -> DataFrame:
    """uid, id, label (bigint), anchor, q (array of int) of the rows that take part, as a table."""
    kind = rows.schema[label_col].dataType
    label = F.col(label_col).cast("bigint") if isinstance(kind, ty.IntegralType) else F.xxhash64(label_col)
    top = float((1 << 31) - 1)
    whole = F.transform(vec_col, lambda x: F.greatest(F.least(F.floor(x.cast("double") * scale).cast("double"), F.lit(top)), F.lit(-top)).cast("int"))
    finite = F.forall(vec_col, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < float("inf")))
    return checkpointed(rows.where(F.col(label_col).isNotNull() & F.col(vec_col).isNotNull() & finite).select(
        F.monotonically_increasing_id().alias("uid"), F.col(id_col).alias("id"), label.alias("label"),
        F.coalesce(anchor, F.lit(False)).alias("anchor"), whole.alias("q")))


def _matrix(col: pa.Array, width: int, dtype) -> np.ndarray:
    """A list column as rows of ``width`` numbers, zeros at the end of shorter ones."""
    off = col.offsets.to_numpy()
    flat = col.values.to_numpy(zero_copy_only=False)[off[0]:off[-1]] if len(col) else np.zeros(0)
    size = np.diff(off)
    if (size == width).all():
        return flat.reshape(-1, width).astype(dtype)
    out = np.zeros((len(col), width), dtype)
    out[np.arange(width)[None, :] < size[:, None]] = flat
    return out


def _units(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    x = x.astype(np.float64)
    norm = np.sqrt((x * x).sum(axis=1))
    return x / np.where(norm > 0, norm, 1.0)[:, None], norm


def centres(base: DataFrame, many: int, width: int) -> np.ndarray:
    """Directions of ``many`` clusters of anchors: spherical k-means over a sample of at most SAMPLE of them."""
    rows = base.where("anchor").orderBy(F.xxhash64("uid"), "uid").select("q").limit(SAMPLE).collect()
    x = np.zeros((len(rows), width))
    for i, r in enumerate(rows):
        x[i, :len(r["q"])] = r["q"]
    x, _ = _units(x)
    c = x[np.linspace(0, len(x) - 1, min(many, len(x))).astype(int)]
    for _ in range(8):
        near = np.argmax(x @ c.T, axis=1)
        total = np.zeros_like(c)
        np.add.at(total, near, x)
        moved, size = _units(total)
        c = np.where(size[:, None] > 0, moved, c)
    return c


def blocks(anchors: DataFrame, centre: np.ndarray, width: int) -> DataFrame:
    """Anchors (uid, label, q, scores) packed by cluster: one binary ``pack`` of at most MEMBERS of them a row."""
    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            near = np.argmax(_units(_matrix(column(b, "q"), width, np.float64))[0] @ centre.T, axis=1) if b.num_rows else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(near.astype(np.int32))], [*b.schema.names, "cluster"])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []

        def out() -> pa.RecordBatch:
            uid, label, q, scores = (np.concatenate(x) for x in zip(*held))
            held.clear()
            unit, norm = _units(q)
            middle = _units(unit.mean(axis=0)[None, :])[0][0]
            cos = (unit @ middle)[norm > 0]
            widest = math.acos(max(-1.0, min(1.0, float(cos.min())))) if len(cos) else 0.0
            head = np.array([len(uid), scores.shape[1]], np.int64)
            data = b"".join(x.tobytes() for x in (head, np.array([widest]), middle, uid, label, scores, q))
            return pa.RecordBatch.from_arrays([pa.array([data], pa.binary())], ["pack"])

        cluster = None
        for b in batches:
            near, uid, label = ints(b, "cluster"), ints(b, "uid"), ints(b, "label")
            q = _matrix(column(b, "q"), width, np.int32)
            scores = column(b, "scores")
            slots = np.full((b.num_rows, POSITIVES if scores.null_count < len(scores) else 0), NONE)
            if slots.shape[1]:
                slots = np.array([[*s, *[NONE] * POSITIVES][:POSITIVES] for s in scores.to_pylist()], np.int64)
            edges = np.flatnonzero(np.diff(near)) + 1
            for i, j in zip([0, *edges.tolist()], [*edges.tolist(), b.num_rows]):
                while i < j:
                    n = sum(len(h[0]) for h in held)
                    if held and (near[i] != cluster or n == MEMBERS):
                        yield out()
                        n = 0
                    cluster = near[i]
                    to = min(j, i + MEMBERS - n)
                    held.append((uid[i:to], label[i:to], q[i:to], slots[i:to]))
                    i = to
        if held:
            yield out()

    spark = anchors.sparkSession
    near = anchors.select("uid", "label", "q", "scores").mapInArrow(
        assign, "uid bigint, label bigint, q array<int>, scores array<bigint>, cluster int")
    slices = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return near.repartitionByRange(slices, "cluster", "uid").sortWithinPartitions("cluster", "uid").mapInArrow(pack, "pack binary")


def _unpack(data: bytes, width: int) -> tuple:
    n, slots = np.frombuffer(data, np.int64, 2)
    real = np.frombuffer(data, np.float64, 1 + width, 16)
    at = 24 + 8 * width
    uid, label = np.frombuffer(data, np.int64, 2 * n, at).reshape(2, n)
    at += 16 * n
    scores = np.frombuffer(data, np.int64, n * slots, at).reshape(n, slots)
    return real[0], real[1:], uid, label, scores, np.frombuffer(data, np.int32, n * width, at + 8 * n * slots).reshape(n, width)


class Best:
    """The first ``k`` rows of each slot by score, id and row number, and the score that a new one must reach."""

    def __init__(self, slots: int, k: int, ids: np.ndarray, uids: np.ndarray):
        self.k, self.ids, self.uids = k, ids, uids
        self.least = np.full(slots, NONE)
        self.slot, self.score, self.at = (np.zeros(0, np.int64) for _ in range(3))

    def add(self, slot: np.ndarray, score: np.ndarray, at: np.ndarray) -> None:
        if not len(slot):
            return
        slot, score, at = np.r_[self.slot, slot], np.r_[self.score, score], np.r_[self.at, at]
        order = np.lexsort((self.uids[at], self.ids[at], -score, slot))
        slot, score, at = slot[order], score[order], at[order]
        first = np.flatnonzero(np.r_[True, slot[1:] != slot[:-1]])
        place = np.arange(len(slot)) - np.repeat(first, np.diff(np.r_[first, len(slot)]))
        full = place == self.k - 1
        self.least[slot[full]] = score[full]
        keep = place < self.k
        self.slot, self.score, self.at = slot[keep], score[keep], at[keep]


class Group:
    """The rows that a task holds, and walks over the list that they make for a cluster."""

    def __init__(self, uid, ids, missing, label, x):
        self.uid, self.ids, self.missing, self.label, self.x = uid, ids, missing, label, x
        self.norm = np.concatenate([np.sqrt((p.astype(np.float64) ** 2).sum(axis=1)) for p in self._parts()]) if len(uid) else np.zeros(0)

    def _parts(self):
        return (self.x[i:i + 16384] for i in range(0, len(self.x), 16384))

    def shared_list(self, middle: np.ndarray, widest: float) -> tuple[np.ndarray, np.ndarray]:
        """(rows by falling bound, the bounds) for members of unit length."""
        dot = np.concatenate([p @ middle for p in (p.astype(np.float64) for p in self._parts())])
        cos = np.clip(dot / np.where(self.norm > 0, self.norm, 1.0), -1.0, 1.0)
        bound = self.norm * np.cos(np.maximum(0.0, np.arccos(cos) - widest))
        order = np.argsort(-bound, kind="stable")
        return order, bound[order]

    def walk(self, order: np.ndarray, bound: np.ndarray, a: np.ndarray, least, visit) -> None:
        """``visit(members, rows, scores)`` for blocks of the list. A member walks on while ``least()``, the score from which
        a row can still enter its results, isn't above its bound."""
        length = np.sqrt((a.astype(np.float64) ** 2).sum(axis=1))
        a = a.astype(self.x.dtype)
        at, step, live = 0, STEP, np.arange(len(a))
        while at < len(order):
            # The margin covers rounding of angles; scores are exact.
            reach = length[live] * max(bound[at], 0.0) * (1 + 1e-6) + np.where(bound[at] < 0, length[live] * bound[at] * (1 - 1e-6), 0.0) + 1e-3
            live = live[reach >= least()[live]]
            if not len(live):
                return
            rows = order[at:at + step]
            visit(live, rows, (a[live] @ self.x[rows].T).astype(np.int64))
            at += step
            step = min(2 * step, 8 * STEP)

    def positives(self, order, bound, uid, label, q, k: int) -> Best:
        best = Best(len(uid), k, self.ids, self.uid)

        def visit(members, rows, score):
            m, r = np.nonzero((score >= best.least[members][:, None]) & (label[members][:, None] == self.label[rows][None, :])
                              & (uid[members][:, None] != self.uid[rows][None, :]))
            best.add(members[m], score[m, r], rows[r])

        self.walk(order, bound, q, lambda: best.least.astype(np.float64), visit)
        return best

    def negatives(self, order, bound, label, scores, q, k: int, low: int, high: int) -> Best:
        many, slots = scores.shape
        best = Best(many * slots, k, self.ids, self.uid)
        none = scores == NONE
        top, floor = np.where(none, 0, scores), np.where(none, 0, -(-(low * np.where(none, 0, scores)) // 100))
        ceiling = (high * top) // 100
        shut = none | (floor > ceiling)  # no score can lie in the window

        def least():
            need = np.maximum(best.least.reshape(many, slots), floor).astype(np.float64)
            return np.where(shut, np.inf, need).min(axis=1)

        def visit(members, rows, score):
            other = label[members][:, None] != self.label[rows][None, :]
            m, r = np.nonzero(other & (score >= least()[members][:, None]))
            s, who = score[m, r], members[m]
            for j in range(slots):
                has = ~shut[who, j] & (s >= floor[who, j]) & (s <= ceiling[who, j]) & (s >= best.least[who * slots + j])
                best.add(who[has] * slots + j, s[has], rows[r[has]])

        self.walk(order, bound, q, least, visit)
        return best


def _search(base: DataFrame, packed: DataFrame, groups: int, width: int, dtype: str, k: int, window: tuple[int, int] | None) -> DataFrame:
    """auid, slot (0 for positives), score, id, uid: the first ``k`` rows of each anchor's slot in each group."""
    names = ["auid", "slot", "score", "id", "uid"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held, group = None, [], None
        for b in batches:
            g, tag = ints(b, "g"), ints(b, "tag")
            edges = np.flatnonzero((np.diff(g) != 0) | (np.diff(tag) != 0)) + 1
            for i, j in zip([0, *edges.tolist()], [*edges.tolist(), b.num_rows]):
                if i == j:
                    continue
                part = b.slice(i, j - i)
                if g[i] != now:
                    now, held, group = g[i], [], None
                if tag[i] == 0:
                    ids = column(part, "id")
                    held.append((ints(part, "uid").astype(np.int64), ids.cast(pa.int64()).fill_null(np.iinfo(np.int64).max).to_numpy(zero_copy_only=False),
                                 ids.is_null().to_numpy(zero_copy_only=False), ints(part, "label").astype(np.int64), _matrix(column(part, "q"), width, dtype)))
                    continue
                if group is None:
                    if not held:  # a group without rows
                        continue
                    group = Group(*(np.concatenate(x) for x in zip(*held)))
                    held = []
                for data in column(part, "pack").to_pylist():
                    widest, middle, uid, label, scores, q = _unpack(data, width)
                    order, bound = group.shared_list(middle, widest)
                    if window is None:
                        best, slots = group.positives(order, bound, uid, label, q, k), 1
                    else:
                        best, slots = group.negatives(order, bound, label, scores, q, k, *window), scores.shape[1]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(uid[best.slot // slots]), pa.array((best.slot % slots).astype(np.int32)), pa.array(best.score),
                         pa.array(group.ids[best.at], mask=group.missing[best.at]), pa.array(group.uid[best.at])], names)

    rows = base.select(F.pmod(F.xxhash64("uid"), F.lit(groups)).cast("int").alias("g"), F.lit(0).alias("tag"), "uid", F.col("id").cast("bigint").alias("id"),
                       "label", "q", F.lit(None).cast("binary").alias("pack"))
    queries = packed.select(F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("g"), F.lit(1).alias("tag"), F.lit(None).cast("bigint").alias("uid"),
                            F.lit(None).cast("bigint").alias("id"), F.lit(None).cast("bigint").alias("label"), F.lit(None).cast("array<int>").alias("q"), "pack")
    return rows.unionByName(queries).repartition(groups, "g").sortWithinPartitions("g", "tag").mapInArrow(
        run, "auid bigint, slot int, score bigint, id bigint, uid bigint")


def _first(found: DataFrame, k: int) -> DataFrame:
    w = Window.partitionBy("auid", "slot").orderBy(F.col("score").desc(), F.col("id").asc_nulls_last(), "uid")
    return found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def mine(rows: DataFrame, anchor: Column, low: int = 80, high: int = 100, scale: int = SCALE, id_col: str = "vec_id",
         label_col: str = "label", vec_col: str = "embedding") -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    For each row where ``anchor`` is true, its POSITIVES most similar rows of the same label, and for each of these the first
    NEGATIVES rows of other labels whose score is from ``low`` to ``high`` percent of the positive's.
    """
    base = quantised(rows, anchor, id_col, label_col, vec_col, scale)
    spark = base.sparkSession
    size = base.agg(F.count("*").alias("n"), F.count_if("anchor").alias("a"), F.max(F.size("q")).alias("width"),
                    F.max(F.aggregate("q", F.lit(0.0), lambda s, x: s + x.cast("double") * x)).alias("square")).first()
    schema = "anchor_id bigint, positive_id bigint, rank int, negative_id bigint, positive_score bigint, negative_score bigint"
    if not size["a"]:
        return spark.createDataFrame([], schema)
    width = max(size["width"], 1)
    dtype = "float32" if size["square"] < 1 << 24 else "float64" if size["square"] < 1 << 53 else "int64"
    groups = max(2 * int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(size["n"] * width / GROUP_VALUES))
    middle = centres(base, min(CENTRES, math.ceil(size["a"] / PER_CENTRE)), width)

    anchors = base.where("anchor").select("uid", F.col("id").alias("anchor_id"), "label", "q")
    packed = blocks(anchors.withColumn("scores", F.lit(None).cast("array<bigint>")), middle, width)
    best = checkpointed(_first(_search(base, packed, groups, width, dtype, POSITIVES, None), POSITIVES).select(
        "auid", (F.col("rank") - 1).alias("slot"), F.col("score").alias("positive_score"), F.col("id").alias("positive_id")))
    scores = best.groupBy("auid").agg(F.transform(F.sort_array(F.collect_list(F.struct("slot", "positive_score"))),  # at most POSITIVES
                                                  lambda x: x["positive_score"]).alias("scores"))
    packed = blocks(anchors.join(scores, anchors["uid"] == scores["auid"]), middle, width)
    found = _first(_search(base, packed, groups, width, dtype, NEGATIVES, (low, high)), NEGATIVES)
    named = anchors.select(F.col("uid").alias("auid"), F.col("anchor_id").cast("bigint").alias("anchor_id"))
    return (found.withColumnRenamed("id", "negative_id").withColumnRenamed("score", "negative_score").drop("uid")
            .join(best, ["auid", "slot"]).join(named, "auid")
            .select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id", "positive_score", "negative_score"))
