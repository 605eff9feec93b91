"""Near duplicates by an exact n-gram Jaccard join with rare-first prefix filtering.

1. One scan gives each document its number of distinct shingles and a 128-bit signature of their set, and counts all
   shingles in a sketch of fixed size. Equal sets form a class; only its smallest id goes on.
2. A second scan orders each set by sketched frequency, rarest first, and emits the prefix that any partner of enough
   similarity must meet (|x| - ceil(t|x|) + 1 shingles). The order is the same everywhere, so the filter loses nothing
   however rough the sketch is.
3. Prefix entries meet by shingle. The first members of a group (the hubs) are paired with all others that pass the
   length and the positional filter. The rest of a large group goes to the next round, which pairs only documents that
   aren't in one component yet, so a group of copies costs pairs in proportion to its size, and a group of unlike
   documents ends up with every pair examined. Rounds go on until no group is left.
4. Each pair is verified once, against the texts: hubs' texts and partners' texts meet by hub (split by a salt where a
   hub has many), a partition histogram of the sets (the suffix filter) discards most that fail, and the exact
   intersection decides.
5. Components of the verified links, and of the classes, give each document its group.

Defined results: null, empty or blank texts have an empty set and link with nothing; a text of fewer than n words has
its word sequence as its one shingle; equal texts are linked; repeated rows with one id count as one document and stay;
a row without an id has its number of shingles, links with nothing, has no component, and is kept by ``one_of_each``; an empty table gives no rows; other columns are never read. Shingles are compared by 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import bloom
from . import textops as T
from .common import checkpointed, column, inflated, ints, pieces
from .components import components

#: log2 of the counters of the frequency sketch: 4 MB in a task, 1 MB broadcast, whatever the size of the corpus.
LOG_SKETCH = 20
_BLOCK = 1 << 12
#: Hubs of a group in the first round; each round takes four times as many.
HUBS = 2
#: Partners of a hub that one verifying task group reads.
SALT_ROWS = 2000


@dataclass(frozen=True)
class Rule:
    """Link when den * |intersection| >= num * |union|."""
    n: int = 5
    num: int = 75
    den: int = 100

    def prefix(self, size: np.ndarray) -> np.ndarray:
        return size - (size * self.num + self.den - 1) // self.den + 1


def _sets(raw: np.ndarray, off: np.ndarray, rule: Rule) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (row, shingle), by row and hash; A-Z count as a-z."""
    _, _, row, h = T.word_hashes(raw, off, T.SPACE, T.LOWER)
    return T.distinct(*T.shingles(h, row, rule.n))


def _slot(h: np.ndarray) -> np.ndarray:
    return (h >> T.U64(64 - LOG_SKETCH)).astype(np.int64)


def _first_scan(docs: DataFrame, rule: Rule) -> DataFrame:
    """Rows of two kinds: a document's size and signature, and blocks of a task's sketch."""
    kind = docs.schema["_id"].dataType.simpleString()
    names = ["_id", "n_shingles", "s1", "s2", "block", "counts"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sketch, id_type = np.zeros(1 << LOG_SKETCH, np.uint32), None
        for rows, raw, off in pieces(batches, "_text"):
            n, id_type = rows.num_rows, column(rows, "_id").type
            row, h = _sets(raw, off, rule)
            sketch += np.bincount(_slot(h), minlength=1 << LOG_SKETCH).astype(np.uint32)
            s1, s2 = np.zeros(n, np.uint64), np.zeros(n, np.uint64)
            np.add.at(s1, row, T.mix(h + T.U64(0x2545F4914F6CDD1D)))
            np.add.at(s2, row, T.mix(h ^ T.U64(0x9E6C63D0876A9A47)))
            yield pa.RecordBatch.from_arrays(
                [column(rows, "_id"), pa.array(np.bincount(row, minlength=n)), pa.array(T.signed(s1)), pa.array(T.signed(s2)),
                 pa.nulls(n, pa.int32()), pa.nulls(n, pa.binary())], names)
        if id_type is not None:
            parts = [(i, c.astype("<u4").tobytes()) for i, c in enumerate(sketch.reshape(-1, _BLOCK)) if c.any()]
            n = len(parts)
            yield pa.RecordBatch.from_arrays(
                [pa.nulls(n, id_type), *(pa.nulls(n, pa.int64()) for _ in range(3)), pa.array([i for i, _ in parts], pa.int32()),
                 pa.array([c for _, c in parts], pa.binary())], names)

    return docs.mapInArrow(run, f"_id {kind}, n_shingles bigint, s1 bigint, s2 bigint, block int, counts binary")


def _frequency_classes(blocks: DataFrame) -> np.ndarray:
    """One byte per counter: eight times the binary logarithm of its count. Blocks are summed by Spark."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for b in batches:
            for i, c in zip(column(b, "block").to_pylist(), column(b, "counts")):
                got = np.frombuffer(c.as_buffer(), "<u4").astype(np.uint64)
                total[i] = total[i] + got if i in total else got
        classes = [np.minimum(255, 8 * np.log2(c + 1.0)).astype(np.uint8).tobytes() for c in total.values()]
        yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int32()), pa.array(classes, pa.binary())], ["block", "classes"])

    got = blocks.repartition(16, "block").mapInArrow(run, "block int, classes binary").collect()
    out = np.zeros(1 << LOG_SKETCH, np.uint8)
    for i, c in got:
        out[i * _BLOCK:(i + 1) * _BLOCK] = np.frombuffer(c, np.uint8)
    return out


def _prefixes(docs: DataFrame, without: DataFrame, rule: Rule, classes) -> DataFrame:
    """(shingle, doc, at) of every prefix entry; ``at`` holds the size of the set in its upper half and, in its lower
    half, the position in rare-first order, from 0."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, raw, off in pieces(batches, "_text"):
            row, h = _sets(raw, off, rule)
            if not len(h):
                continue
            order = np.argsort(row * 256 + classes.value[_slot(h)], kind="stable")  # ties stay in the order of the hash
            row, h = row[order], h[order]
            size = np.bincount(row, minlength=rows.num_rows)
            pos = np.arange(len(row)) - np.r_[0, np.cumsum(size)[:-1]][row]
            keep = pos < rule.prefix(size)[row]
            row, h, pos = row[keep], h[keep], pos[keep]
            yield pa.RecordBatch.from_arrays(
                [pa.array(T.signed(h)), column(rows, "_id").take(pa.array(row)), pa.array(size[row] << 32 | pos)], ["shingle", "doc", "at"])

    return bloom.map_without_ids(docs, without, run, "shingle bigint, doc bigint, at bigint")


def _meet(entries: DataFrame, order: list[str], rule: Rule, hubs: int) -> DataFrame:
    """Pairs (a, b) of the hubs of each group with its later members, and the other members (b null) of large groups.

    Reads sorted groups as a stream: what a task holds is one batch and the hubs of the group at hand.
    """
    n = int(entries.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    has_comp = "comp" in entries.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, first = None, np.zeros((0, 4), np.int64)  # the hubs so far of the group that goes on into this batch
        for b in batches:
            k = ints(b, "shingle")
            if not len(k):
                continue
            at = ints(b, "at")
            rows = np.stack([ints(b, "doc"), at >> 32, at & 0xFFFFFFFF, ints(b, "comp" if has_comp else "doc")], 1)
            start = np.flatnonzero(np.r_[True, k[1:] != k[:-1]])
            end = np.r_[start[1:], len(k)]
            out, left = [], []
            goes_on = key is not None and k[0] == key
            busy = np.flatnonzero(end - start > 1)
            for g in sorted({*busy.tolist(), *([0] if goes_on else [])}):
                a, z = int(start[g]), int(end[g])
                own = rows[a:z]
                old = first if g == 0 and goes_on else own[:0]
                hub = np.concatenate([old, own[:hubs - len(old)]]) if len(old) < hubs else old
                for i, x in enumerate(hub):
                    y = own[max(0, i + 1 - len(old)):] if i >= len(old) else own
                    small, large = np.minimum(x[1], y[:, 1]), np.maximum(x[1], y[:, 1])
                    room = np.minimum(x[1] - x[2], y[:, 1] - y[:, 2])
                    ok = (rule.den * small >= rule.num * large) & ((rule.num + rule.den) * room >= rule.num * (x[1] + y[:, 1]))
                    ok &= (x[3] != y[:, 3]) & (x[0] != y[:, 0])
                    if ok.any():
                        out.append(np.stack([np.minimum(x[0], y[ok, 0]), np.maximum(x[0], y[ok, 0])], 1))
                rest = own[max(0, hubs - len(old)):]
                if len(rest):
                    left.append(np.c_[np.full(len(rest), k[a]), rest[:, 0], rest[:, 1] << 32 | rest[:, 2]])
                if g == len(start) - 1:
                    first = hub
            if not (goes_on and len(start) == 1) and (len(start) - 1) not in busy:
                first = rows[start[-1]:][:hubs]
            key = k[-1]
            for kind, found in (("pair", out), ("rest", left)):
                if found:
                    m = np.concatenate(found)
                    if kind == "pair":
                        m = np.unique(m, axis=0)
                    for i in range(0, len(m), 1 << 16):
                        p = m[i:i + (1 << 16)]
                        none = pa.nulls(len(p), pa.int64())
                        cols = [p[:, 0], p[:, 1], none, none, none] if kind == "pair" else [none, none, *p.T]
                        yield pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(np.ascontiguousarray(c)) for c in cols],
                                                         ["a", "b", "shingle", "doc", "at"])

    parts = entries.repartition(n, "shingle").sortWithinPartitions("shingle", *order)
    return parts.mapInArrow(run, "a bigint, b bigint, shingle bigint, doc bigint, at bigint")


def _histogram(h: np.ndarray, row: np.ndarray, n: int) -> np.ndarray:
    """Members of each set in 16 equal ranges of the hash."""
    return np.bincount(row * 16 + (h >> T.U64(60)).astype(np.int64), minlength=16 * n).reshape(n, 16)


def verify(pairs: DataFrame, texts: DataFrame, rule: Rule) -> DataFrame:
    """The pairs (a, b) that the rule links. ``texts`` (_id, deflated _text) has at least their documents."""
    salts = pairs.groupBy("a").agg(F.ceil(F.count("*") / SALT_ROWS).cast("int").alias("salts"))
    hubs = salts.select(F.col("a").alias("_id"), F.col("a").alias("hub"), F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"),
                        F.lit(0).alias("part"))
    others = pairs.join(salts, "a").select(F.col("b").alias("_id"), F.col("a").alias("hub"),
                                           F.pmod(F.xxhash64("b"), F.col("salts")).cast("int").alias("salt"), F.lit(1).alias("part"))
    n = int(pairs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = hubs.unionByName(others).join(texts, "_id").repartition(n, "hub", "salt").sortWithinPartitions("hub", "salt", "part", "_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hub, own, own_hist = None, None, None
        for part, raw, off in pieces(inflated(batches), "_text"):
            row, h = _sets(raw, off, rule)
            size = np.bincount(row, minlength=part.num_rows)
            at = np.r_[0, np.cumsum(size)]
            hist = _histogram(h, row, part.num_rows)
            of, kind, ids = ints(part, "hub"), ints(part, "part"), ints(part, "_id")
            start = np.flatnonzero(np.r_[True, (of[1:] != of[:-1]) | (kind[1:] != kind[:-1])])
            a_out, b_out = [], []
            for s, e in zip(start.tolist(), [*start[1:].tolist(), part.num_rows]):
                if kind[s] == 0:
                    hub, own, own_hist = of[s], h[at[s]:at[s + 1]].copy(), hist[s].copy()
                    continue
                sizes = size[s:e]
                # suffix filter: the sets differ in at least sum |difference| members, so they share at most this many
                most = (sizes + len(own) - np.abs(hist[s:e] - own_hist).sum(1)) // 2
                need = (rule.den + rule.num) * most >= rule.num * (sizes + len(own))
                if not need.any():
                    continue
                seg, rows_ = h[at[s]:at[e]], row[at[s]:at[e]] - s
                if not need.all():
                    m = need[rows_]
                    seg, rows_ = seg[m], rows_[m]
                found = np.searchsorted(own, seg)
                found[found == len(own)] = 0
                both = np.bincount(rows_[own[found] == seg], minlength=e - s) if len(own) else np.zeros(e - s, np.int64)
                ok = (rule.den * both >= rule.num * (sizes + len(own) - both)) & need
                a_out += [hub] * int(ok.sum())
                b_out += ids[s:e][ok].tolist()
            yield pa.RecordBatch.from_arrays([pa.array(a_out, pa.int64()), pa.array(b_out, pa.int64())], ["a", "b"])

    return rows.mapInArrow(run, "a bigint, b bigint")


def near_duplicates(docs: DataFrame, rule: Rule = Rule(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, n_shingles, component_id (the smallest id reachable by links). Ids are integers."""
    spark = docs.sparkSession
    x = docs.select(F.col(id_col).cast("bigint").alias("_id"), F.col(text_col).alias("_text"))
    first = checkpointed(_first_scan(x, rule))
    every = first.where("block IS NULL").select("_id", "n_shingles", "s1", "s2")
    x, info = x.where("_id IS NOT NULL"), every.where("_id IS NOT NULL")
    classes = spark.sparkContext.broadcast(_frequency_classes(first.where("block IS NOT NULL").select("block", "counts")))

    sets = info.where("n_shingles > 0").groupBy("n_shingles", "s1", "s2").agg(F.min("_id").alias("rep"), F.count("*").alias("n"))
    copies = sets.where("n > 1").select("n_shingles", "s1", "s2", "rep")
    member = checkpointed(info.join(copies, ["n_shingles", "s1", "s2"]).select("_id", "rep").where("_id <> rep").distinct())
    entries = _prefixes(x, member, rule, classes)

    links, tried, order, hubs = None, None, ["doc"], HUBS
    while True:
        met = checkpointed(_meet(entries, order, rule, hubs))
        pairs = met.where("a IS NOT NULL").select("a", "b").distinct()
        if tried is not None:
            pairs = pairs.join(tried, ["a", "b"], "left_anti")
        pairs = checkpointed(pairs)
        tried = pairs if tried is None else tried.unionByName(pairs)
        if not pairs.isEmpty():
            ids = pairs.select(F.explode(F.array("a", "b")).alias("_id"))
            found = checkpointed(verify(pairs, bloom.texts_of(x, ids), rule))
            links = found if links is None else checkpointed(links.unionByName(found))
            comp = components(links)
        rest = met.where("doc IS NOT NULL").select("shingle", "doc", "at")
        if rest.isEmpty():
            break
        known = comp.select(F.col("node").alias("doc"), F.col("component").alias("c")) if links is not None else None
        rest = rest.join(known, "doc", "left").withColumn("comp", F.coalesce("c", "doc")).drop("c") if known is not None \
            else rest.withColumn("comp", F.col("doc"))
        mixed = rest.groupBy("shingle").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo <> hi").select("shingle")
        many = rest.groupBy("shingle", "comp").agg(F.count("*").alias("often"))
        entries = checkpointed(rest.join(mixed, "shingle", "left_semi").join(many, ["shingle", "comp"]))
        if entries.isEmpty():
            break
        order, hubs = ["often", "comp", "doc"], hubs * 4  # the members of small components are the next hubs

    edges = member.select(F.col("_id").alias("a"), F.col("rep").alias("b"))
    comp = components(edges.unionByName(links) if links is not None else edges)
    return every.join(comp.withColumnRenamed("node", "_id"), "_id", "left").select(
        F.col("_id").alias(id_col), "n_shingles", F.coalesce("component", "_id").alias("component_id"))


def one_of_each(docs: DataFrame, rule: Rule = Rule(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with the smallest id of each group alone; all columns as they are."""
    near = near_duplicates(docs, rule, id_col, text_col)
    return bloom.without_ids(docs, checkpointed(near.where(F.col(id_col) != F.col("component_id")).select(id_col)), id_col)
