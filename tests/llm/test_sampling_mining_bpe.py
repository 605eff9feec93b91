"""Importance resampling, hard negatives and BPE against plain Python versions, and their edge cases."""

import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tablegrad.llm import bpe, catalog, hard_negatives, importance
from tablegrad.plans.verify import duck_connection

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck_connection(SF)


# --- importance resampling

def naive_features(text):
    low = (text or "").encode().translate(bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123))))
    w = re.findall(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
    return len(w), [b" ".join(w[i:i + n]) for n in (1, 2, 3) for i in range(len(w) - n + 1)]


def naive_resample(docs, target, percent=5, least=20):
    s, t = [0] * 10_000, [0] * 10_000
    for texts, out in (([x for _, x in docs], s), (target, t)):
        for x in texts:
            for f in naive_features(x)[1]:
                out[zlib.crc32(f) % 10_000] += 1
    many_s, many_t = sum(s), sum(t)
    gain = [math.floor(1000 * math.log((b + 1) * (many_s + 10_000) / ((a + 1) * (many_t + 10_000)))) for a, b in zip(s, t)]
    rows, can = [], []
    for d, x in docs:
        words, f = naive_features(x)
        weight = sum(gain[zlib.crc32(g) % 10_000] for g in f)
        h = int(hashlib.sha256(f"42:{d}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append((d, len(f), weight, score))
        if words >= least:
            can.append((-score, d))
    rank = {d: i + 1 for i, (_, d) in enumerate(sorted(can)[:percent * len(can) // 100])}
    return sorted((d, n, w, s, rank.get(d)) for d, n, w, s in rows)


def test_op11_equals_brute_force(spark, con):
    docs = con.sql("SELECT doc_id, text FROM documents").fetchall()
    want = naive_resample(docs, [x for x, in con.sql("SELECT text FROM benchmark").fetchall()])
    got = sorted(tuple(r) for r in catalog.op11_importance(spark, SF).select("doc_id", "n_features", "weight", "score", "rank").collect())
    assert got == want and sum(r[-1] is not None for r in got) > 5


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 900), st.integers(1, 700)), min_size=1, max_size=20), st.integers(0, 1 << 30))
def test_span_checksums(spans, seed):
    buf = np.random.default_rng(seed).integers(0, 256, 1600).astype(np.uint8)
    at, size = np.array(spans).T
    got = importance.span_crc32(buf, at, at + size)
    assert got.tolist() == [zlib.crc32(buf[i:i + n].tobytes()) for i, n in spans]


def test_long_spans_checksum():
    buf = np.random.default_rng(1).integers(0, 256, 1_400_000).astype(np.uint8)
    at, end = np.array([0, 5, 100]), np.array([1_400_000, 5 + 256 * 1024, 100 + 256 * 2048 + 1])
    assert importance.span_crc32(buf, at, end).tolist() == [zlib.crc32(buf[i:j].tobytes()) for i, j in zip(at, end)]


def test_op11_edges(spark):
    long = "w" * 300_000 + " Ünï 7 " + "x " * 50
    data = [(1, None), (2, ""), (None, "a b c"), (3, long), (3, long), (4, "one two"), (None, None), (5, "\x7f!? ")] + \
        [(i, " ".join(f"t{i * j % 13}" for j in range(20 + i))) for i in range(6, 120)]
    df = spark.createDataFrame(data, "doc_id bigint, text string").selectExpr("*", "'x' AS _id", "0 AS rank", "1 AS weight", "2 AS _row")
    target = spark.createDataFrame([("t1 t2 t3 x x",), (None,)], "text string")
    got = importance.resample(df, target, percent=50).select("doc_id", "n_features", "weight", "score", "rank").collect()
    assert len(got) == len(data)
    assert all(r.weight == 0 and r.n_features == 0 and r["rank"] is None for r in got if r.doc_id in (1, 2, 5))
    ranks = sorted(r["rank"] for r in got if r["rank"] is not None)
    assert ranks == list(range(1, len(ranks) + 1)) == list(range(1, (114 + 2) * 50 // 100 + 1))
    drawn = sorted((r for r in got if r["rank"]), key=lambda r: r["rank"])
    assert all(a.score >= b.score for a, b in zip(drawn, drawn[1:]))
    assert {r.n_features for r in got if r.doc_id == 3} == {len(naive_features(long)[1])}
    assert importance.resample(df.limit(0), target).count() == 0
    none = importance.resample(df, target.limit(0)).where("doc_id = 4").first()
    assert none.n_features == 3


def test_ranks_of_ties_and_repeated_rows(spark):
    rows = spark.createDataFrame([(7, True)] * 500 + [(i, True) for i in range(300)] + [(i, False) for i in range(50)], "v int, ok boolean")
    got = importance.ranked(rows, "ok", [F.col("v").desc()], 50).collect()
    order = sorted((r["rank"], r["v"]) for r in got if r["rank"] is not None)
    assert [r for r, _ in order] == list(range(1, 401))
    assert [v for _, v in order] == sorted([7] * 500 + list(range(300)), reverse=True)[:400]


# --- hard negatives

def naive_mine(rows, low=80, high=100):
    """``rows``: (uid, id, label, vector, anchor)."""
    use = [(u, i, y, [math.floor(256 * x) for x in v], a) for u, i, y, v, a in rows
           if y is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    dot = lambda p, q: sum(x * z for x, z in zip(p, q))
    key = lambda r: (-r[0], r[1] is None, r[1] or 0, r[2])
    out = []
    for u, i, y, v, a in use:
        if not a:
            continue
        scored = [(dot(v, w), j, t, z == y) for t, j, z, w, _ in use if t != u]
        for ps, pid, _, _ in sorted((r for r in scored if r[3]), key=key)[:5]:
            fit = sorted((r for r in scored if not r[3] and low * ps <= 100 * r[0] <= high * ps), key=key)[:5]
            out += [(i, pid, n + 1, r[1], ps, r[0]) for n, r in enumerate(fit)]
    return sorted(out, key=str)


MINED = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]


def mined(df, **options):
    return sorted((tuple(r) for r in hard_negatives.mine(df, F.col("vec_id") % 100 == 0, **options).select(*MINED).collect()), key=str)


def test_op12_equals_brute_force(spark, con):
    data = con.sql("SELECT vec_id, embedding, label FROM embeddings").fetchall()
    rows = [(k, i, (y + 1) % 10 if i % 7 == 0 else y, [float(x) for x in v], i % 100 == 0) for k, (i, v, y) in enumerate(data)]
    got = sorted((tuple(r) for r in catalog.op12_hard_negatives(spark, SF).select(*MINED).collect()), key=str)
    assert got == naive_mine(rows) and len(got) > 20


def test_clustered_lists_end_early_and_stay_exact(spark, monkeypatch):
    rng = np.random.default_rng(3)
    middle = rng.normal(size=(12, 16)) * 3
    vecs = [(middle[i % 12] * rng.uniform(0.2, 2) + rng.normal(size=16) * 0.2).tolist() for i in range(3000)]
    data = [(i * 4, v, int(rng.integers(0, 4))) for i, v in enumerate(vecs)]
    df = spark.createDataFrame(data, "vec_id bigint, embedding array<double>, label int")
    rows = [(k, i, y, v, i % 100 == 0) for k, (i, v, y) in enumerate(data)]
    assert mined(df) == naive_mine(rows)
    # One group and small steps: a walk of a tight cluster visits a part of its list only.
    monkeypatch.setattr(hard_negatives, "STEP", 64)
    x = np.floor(256 * np.array(vecs)).astype(np.float64)
    g = hard_negatives.Group(np.arange(3000), np.arange(3000) * 4, np.zeros(3000, bool), np.array([y for *_, y in data]), x)
    members = np.arange(0, 3000, 300)  # all of one cluster
    unit, _ = hard_negatives._units(x[members])
    c = hard_negatives._units(unit.mean(axis=0)[None, :])[0][0]
    order, bound = g.shared_list(c, math.acos(min(1.0, float((unit @ c).min()))))
    top = x[members] @ x[order].T
    assert (np.linalg.norm(x[members], axis=1)[:, None] * bound[None, :] * (1 + 1e-6) + 1e-3 >= top).all()
    seen = []
    walk = g.walk
    g.walk = lambda o, b, a, least, visit: walk(o, b, a, least, lambda m, r, s: (seen.append(len(r)), visit(m, r, s)))
    g.positives(order, bound, members, np.array([data[m][2] for m in members]), x[members], 5)
    assert sum(seen) < 1500


def test_op12_edges(spark):
    inf, nan = float("inf"), float("nan")
    rng = random.Random(5)
    vec = lambda: [rng.uniform(-1, 1) for _ in range(4)]
    same = [0.5, 0.25, -0.5, 0.125]
    data = [(100, same, 1), (100, same, 1), (200, same, None), (300, None, 2), (400, [1.0, nan, 0.0, 0.0], 2), (500, [1.0, inf, 0.0, 0.0], 2),
            (600, [1.0, None, 0.0, 0.0], 2), (700, [0.0] * 4, 3), (800, [], 3), (900, [0.5, 0.5], 3), (None, same, 2), (None, vec(), 1), (1000, [3000.0, 1.0, 2.0, 3.0], 1)]
    data += [(i, same, i % 3) for i in range(1, 40)] + [(i, vec(), i % 3) for i in range(40, 99)]
    df = spark.createDataFrame(data, "vec_id bigint, embedding array<double>, label int").selectExpr("*", "1 AS uid", "'a' AS anchor", "2 AS rank", "3 AS q")
    want = naive_mine([(k, i, y, v, i is not None and i % 100 == 0) for k, (i, v, y) in enumerate(data)])
    got = mined(df)
    assert got == want and len(want) > 10
    assert mined(df.limit(0)) == [] and mined(df.where("vec_id % 100 <> 0")) == []
    assert mined(df.where("vec_id IN (100, 1, 3) AND label = 1")) == []  # no other label
    big = [(i, [(-1.0) ** i * 4e6 * (i % 5 + 1), 1e6 * i, 3.0], i % 2) for i in range(0, 120, 4)] + [(i, [1e5 * i, 7.0, 1.0], 1) for i in range(1, 20)]
    df = spark.createDataFrame(big, "vec_id bigint, embedding array<double>, label int")
    assert mined(df) == naive_mine([(k, i, y, v, i % 100 == 0) for k, (i, v, y) in enumerate(
        (i, [max(min(x, (2 ** 31 - 1) / 256), (1 - 2 ** 31) / 256) for x in v], y) for i, v, y in big)])


# --- byte-level BPE

@pytest.fixture(scope="module")
def tokenizer():
    import public_tokenizers
    return tiktoken.Encoding("whole", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.ranks_of(bpe.default_ranks()), special_tokens={})


def digest(tokenizer, text):
    ids = tokenizer.encode_ordinary(text or "")
    return len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()


def test_op13_equals_the_library(spark, con, tokenizer):
    want = sorted((d, *digest(tokenizer, t)) for d, t in con.sql("SELECT doc_id, text FROM documents").fetchall())
    assert sorted(tuple(r) for r in catalog.op13_bpe(spark, SF).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256").collect()) == want


ODD = ["'", "s", "t", "re", "ve", "ll", "m", "d", " ", "  ", "\n", "\t", "　", " ", "\x85", "a", "Ω", "é", "9", "٣", "²", "!", "--", "😀", "́", "S", "\r\n", "字", "​"]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.one_of(st.lists(st.sampled_from(ODD), max_size=14).map("".join), st.text(max_size=20)), min_size=1, max_size=8))
def test_pre_tokens_are_those_of_the_pattern(texts):
    import public_tokenizers
    whole = tiktoken.Encoding("w", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.ranks_of(bpe.default_ranks()), special_tokens={})
    data = [t.encode() for t in texts]
    raw, off = np.frombuffer(b"".join(data), np.uint8), np.cumsum([0, *map(len, data)])
    start, end, counts = bpe.spans(raw, off)
    found = [b"".join(data)[i:j] for i, j in zip(start, end)]
    at = 0
    for t, n in zip(texts, counts):
        words, at = found[at:at + n], at + n
        assert b"".join(words) == t.encode()
        assert [i for w in words for i in whole._encode_single_piece(w)] == whole.encode_ordinary(t)


def test_op13_edges(spark, tokenizer):
    texts = [None, "", " ", "a", "it's  we'll'd 'sx\n\n x", "\n", "zebra " * 4000, "q" * 60_000, "Ä字😀 ٣٣", "it's  we'll'd 'sx\n\n x", "\x00\x01 '", "''s '"]
    data = [(i % 9 if i % 5 else None, t) for i, t in enumerate(texts)] * 3
    df = spark.createDataFrame(data, "doc_id bigint, text string").repartition(3).selectExpr("*", "1 AS chunk", "2 AS code", "'w' AS data", "3 AS _id")
    enc = bpe.encode(df, chunk=3000)
    rows = bpe.decode(enc).collect()
    key = lambda x: str(x)
    assert sorted(((r.doc_id, np.frombuffer(r.ids, "<u4").tolist(), bytes(r.decoded)) for r in rows), key=key) == sorted(
        ((d, tokenizer.encode_ordinary(t or ""), (t or "").encode()) for d, t in data), key=key)
    assert bpe.decode(bpe.encode(df.limit(0))).count() == 0
    assert bpe.encode(df.where("text IS NULL")).where(F.octet_length("ids") == 0).count() == 3
    bad = spark.createDataFrame([(1, bytearray(np.array([60_000], "<u4").tobytes()))], "doc_id bigint, ids binary")
    with pytest.raises(Exception, match="outside the vocabulary"):
        bpe.decode(bad).collect()
