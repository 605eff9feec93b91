"""Byte and record ranges of files, re-runnable batch writes, shuffling by a permutation."""

import gzip

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tablegrad.operators import batching
from tablegrad.sources import idx, kv, ranges


def lines_of(spark, folder, **o):
    return [(r.line_no, r.line) for r in ranges.number_lines(ranges.read_lines(spark, str(folder), **o)).orderBy("file", "line_no").collect()]


TEXT = ["Partition 1: avg batch loss = 0.5", "", "ünï ≥ ਊ字😀 Ċ", "x" * 100, "Partition 2: avg batch loss = 1.25", "last"]


@pytest.mark.parametrize("end", ["", "\n"])
@pytest.mark.parametrize("encoding,mark", [("UTF-8", b""), ("UTF-8", b"\xef\xbb\xbf"), ("UTF-16LE", b""), ("UTF-16BE", b""), ("UTF-16", b"\xff\xfe"), ("UTF-16", b"\xfe\xff")])
def test_lines_of_every_range_size(spark, tmp_path, monkeypatch, encoding, mark, end):
    codec = {b"\xff\xfe": "utf-16-le", b"\xfe\xff": "utf-16-be"}.get(mark, encoding)
    (tmp_path / "a.log").write_bytes(mark + ("\r\n".join(TEXT) + end).encode(codec))
    for size in (2, 3, 7, 64, 1 << 20):
        reader = ranges.LineReader({"path": str(tmp_path), "encoding": encoding, "rangebytes": str(size)})
        for chunk in (3, 16, 1 << 20):
            monkeypatch.setattr(ranges, "CHUNK", chunk)
            got = [x for p in reader.partitions() for b in reader.read(p) for x in b.column(3).to_pylist()]
            assert got == TEXT, (size, chunk)


def test_lines_as_a_table(spark, tmp_path):
    for k in range(2):
        (tmp_path / f"{k}.log").write_text("\n".join(f"{k} line {i}" for i in range(500)), encoding="utf-16")
    (tmp_path / "_ignored.log").write_text("no")
    got = lines_of(spark, tmp_path, encoding="UTF-16", range_bytes=300, pattern="*.log")
    assert got == [(i, f"{k} line {i}") for k in range(2) for i in range(500)]
    assert ranges.read_lines(spark, str(tmp_path), "UTF-16", "*.log", 300).rdd.getNumPartitions() > 50
    assert lines_of(spark, tmp_path, pattern="none*") == []
    with pytest.raises(Exception, match="encoding"):
        lines_of(spark, tmp_path, encoding="latin-7", pattern="*.log")


def images(n, seed=0):
    return np.random.default_rng(seed).integers(0, 256, (n, 6)).astype(np.uint8)


def test_idx_by_record_ranges(spark, tmp_path):
    x, y = images(700), np.arange(700, dtype=np.uint8)
    plain = gzip.decompress(idx.encode_idx("images", x, 2, 3))
    (tmp_path / "p-images.idx").write_bytes(plain)
    (tmp_path / "p-labels.idx").write_bytes(gzip.decompress(idx.encode_idx("labels", y)))
    (tmp_path / "z-images.idx.gz").write_bytes(gzip.compress(plain[:1000]) + gzip.compress(plain[1000:]))
    (tmp_path / "z-labels.idx.gz").write_bytes(idx.encode_idx("labels", y))
    rows = ranges.read_idx(spark, str(tmp_path), range_bytes=600)
    assert rows.rdd.getNumPartitions() == 7 + 2 + 2
    by_range, whole = (sorted((r.shard, r.idx, bytes(r.pixels), r.label) for r in idx.pair_images_labels(d).collect())
                       for d in (rows, idx.read_idx(spark, str(tmp_path))))
    assert by_range == whole and len(whole) == 1400 and whole[5] == ("p", 5, x[5].tobytes(), 5)


def test_idx_files_that_are_broken(spark, tmp_path):
    x = idx.encode_idx("images", images(50), 2, 3)
    for name, data in (("short.idx", gzip.decompress(x)[:-1]), ("cut.idx.gz", x[:-20]), ("long.idx.gz", gzip.compress(gzip.decompress(x) + b"0")),
                       ("magic.idx", b"\0\0\x08\x05" + b"0" * 20), ("few.idx.gz", gzip.compress(gzip.decompress(x)[:-6])), ("empty.idx", b"")):
        (tmp_path / name).write_bytes(data)
        with pytest.raises(Exception, match="mismatch|magic"):
            ranges.read_idx(spark, str(tmp_path / name)).count()
    with pytest.raises(Exception, match="nowhere"):
        ranges.read_idx(spark, str(tmp_path / "nowhere")).count()


def test_a_large_gzip_stream_is_unpacked_by_chunks(tmp_path, monkeypatch):
    monkeypatch.setattr(ranges, "CHUNK", 4096)
    x = np.zeros((40_000, 6), np.uint8)  # packs a thousandfold
    (tmp_path / "i.idx.gz").write_bytes(idx.encode_idx("images", x, 2, 3))
    reader = ranges.IdxReader({"path": str(tmp_path)})
    sizes = [b.num_rows for p in reader.partitions() for b in reader.read(p)]
    assert sum(sizes) == 40_000 and max(sizes) <= 4096 // 6 + 2


def test_put_files_is_repeatable(spark, tmp_path):
    df = spark.createDataFrame([(f"f{i}", bytes([i]) * i) for i in range(5)], "path string, content binary")
    for _ in range(2):
        assert sorted(tuple(r) for r in ranges.put_files(df, f"file://{tmp_path}/out").collect()) == [(f"f{i}", i) for i in range(5)]
    assert sorted(p.name for p in (tmp_path / "out").iterdir()) == [f"f{i}" for i in range(5)]
    assert (tmp_path / "out" / "f3").read_bytes() == b"\x03" * 3


# --- batches that a second run leaves alone

def test_a_batch_is_written_once(spark, tmp_path):
    rows = spark.createDataFrame([(f"k{i}", bytes([i]), bytes(4)) for i in range(10)], "row_key string, image binary, label binary")
    path = f"{tmp_path}/t"
    assert kv.read_batches(spark, path).count() == 0
    assert kv.write_batch(rows.limit(4), path, 0) and not kv.write_batch(rows.limit(4), path, 0)
    assert kv.write_batch(rows.where("row_key > 'k5'"), path, 7)
    assert kv.read_batches(spark, path).count() == 8 and kv.manifest(spark, path).count() == 2
    # An attempt that died before its manifest: readers don't see it, and a second run of the batch writes it.
    rows.write.parquet(f"{path}/data/batch-3-dead")
    (tmp_path / "t" / "manifest" / "3").mkdir()
    assert kv.read_batches(spark, path).count() == 8
    assert kv.write_batch(rows.limit(1), path, 3) and kv.read_batches(spark, path).count() == 9


# --- permutation

@pytest.mark.parametrize("n", [1, 2, 3, 5, 16, 17, 99, 1000, 4097])
def test_places_are_a_permutation(spark, n):
    seen = set()
    for seed, epoch in ((1, 0), (1, 1), (2, 0)):
        got = [r[0] for r in spark.range(n).orderBy("id").select(batching.shuffle_permutation("id", n, seed, epoch)).collect()]
        assert sorted(got) == list(range(n))
        seen.add(tuple(got))
    assert len(seen) == 3 or n < 6


def test_a_shuffle_spreads_neighbours(spark):
    n = 20_000
    got = np.array([r[0] for r in spark.range(n).orderBy("id").select(batching.shuffle_permutation("id", n, 3)).collect()])
    assert abs(np.corrcoef(np.arange(n), got)[0, 1]) < 0.03
    step = np.abs(np.diff(got))
    assert 0.3 < step.mean() / n < 0.37 and (step == 1).mean() < 0.002
    with pytest.raises(Exception, match="outside"):
        spark.range(n + 1).select(batching.shuffle_permutation("id", n, 3)).collect()


@settings(max_examples=20, deadline=None)
@given(st.integers(1, 400), st.integers(1, 7), st.integers(1, 50))
def test_batches_of_a_permutation(n, parts, size):
    from pyspark.sql import SparkSession
    spark = SparkSession.getActiveSession()
    rows = batching.shuffled_batches(spark.range(n), "id", n, parts, size, 5, 2).collect()
    for p in range(parts):
        own = sorted(r.row_in_part for r in rows if r.part == p)
        assert own == list(range(len(range(p, n, parts))))
        for r in rows:
            if r.part == p:
                assert r.batch_id == r.row_in_part // size and r.nbatches == -(-len(own) // size)
                assert r.bsize == sum(q // size == r.batch_id for q in own)


def test_the_plan_has_no_exchange(spark):
    df = batching.shuffled_batches(spark.range(1000), "id", 1000, 4, 32, 1)
    assert "Exchange" not in df._jdf.queryExecution().executedPlan().toString()
    assert df.agg(F.count_distinct("part", "row_in_part")).first()[0] == 1000
