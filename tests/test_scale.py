"""Work per task that doesn't grow with the tables."""

import gzip

import numpy as np
import pytest
from pyspark.sql import functions as F

from tablegrad.operators import nn
from tablegrad.sources import idx, ranges


def test_cells_of_batch_norm_are_not_dealt_by_feature(spark):
    cells = spark.range(2000).select("id", F.explode(F.sequence(F.lit(0), F.lit(3))).alias("j"), (F.col("id") % 7).cast("double").alias("x"))
    buffers = cells.groupBy("j").agg(F.avg("x").alias("running_mean"), F.var_pop("x").alias("running_var"))
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as with tables too large to tell
    try:
        out = nn.batchnorm_eval_cells(cells, buffers, np.ones(4), np.zeros(4))
        assert "SortMergeJoin" not in out._jdf.queryExecution().executedPlan().toString()
        got = out.orderBy("id", "j").collect()
        with pytest.raises(Exception, match="no buffers"):
            nn.batchnorm_eval_cells(cells, buffers.where("j <> 2"), np.ones(4), np.zeros(4)).collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    x = np.arange(2000) % 7
    assert np.allclose([r.y for r in got], np.repeat((x - x.mean()) / np.sqrt(x.var() + 1e-5), 4)) and len(got) == 8000


@pytest.mark.parametrize("encoding", ["UTF-8", "utf-16"])
def test_many_small_ranges_are_few_partitions(tmp_path, encoding):
    want = []
    for k in range(400):
        own = [f"{k} line {i} ਊĊ" + "x" * (200 * (i == 7)) for i in range(k % 20 + 1)]
        (tmp_path / f"{k:03}.log").write_text("\n".join(own), encoding=encoding)
        want += [(f"{k:03}.log", x) for x in own]
    reader = ranges.LineReader({"path": str(tmp_path), "encoding": encoding.upper(), "rangebytes": "50"})
    parts = reader.partitions()
    assert 100 < len(parts) <= 128 and sum(len(p.ranges) for p in parts) > 2000
    got, places = [], {}
    for p in parts:
        for b in reader.read(p):
            for file, number, place, line in zip(*(c.to_pylist() for c in b.columns)):
                assert place == places.get((file, number), 0)
                places[file, number] = place + 1
                got.append((file[-7:], line))
    assert got == want


def test_many_small_record_ranges_are_few_partitions(tmp_path):
    x = np.arange(300 * 24, dtype=np.int64).reshape(300, 4, 6).astype(np.uint8)
    for k in range(300):
        raw = idx.encode_idx("images", x[k], 2, 3)
        (tmp_path / f"{k:03}-images.idx").write_bytes(raw if k % 3 == 0 else gzip.decompress(raw))
    reader = ranges.IdxReader({"path": str(tmp_path), "rangebytes": "6"})
    parts = reader.partitions()
    assert len(parts) <= 128
    got = [bytes(v) for p in parts for b in reader.read(p) for v in b.column(4).to_pylist()]
    assert got == [r.tobytes() for r in x.reshape(-1, 6)]


def test_ranges_of_full_size_have_partitions_of_their_own():
    whole = [ranges.Range("f", k, 0, 0, ranges.RANGE_BYTES) for k in range(1000)]
    assert len(ranges.deal(whole)) == 1000
    small = [ranges.Range("f", k, 0, 0, 32 << 10) for k in range(100_000)]
    assert max(len(p.ranges) for p in ranges.deal(small)) <= 350
    assert [r.number for p in ranges.deal(small) for r in p.ranges] == list(range(100_000))
