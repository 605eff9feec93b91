"""Sources and sinks: blob codec, labels and keys, IDX files, loss logs, upsert."""

import gzip
import os
import tempfile

import numpy as np
import pytest
from pyspark.sql import functions as F

from tablegrad.sources import blobs, idx, kv, losslog


def test_blob_layout_and_errors():
    x = np.array([[1.0, 2.0, 3.0, 4.0]])
    le = blobs.encode_matrix(x, (2, 2), True, "little")[0].as_py()
    assert le[:4] == (2).to_bytes(4, "little") and le[12] == 1 and len(le) == 4 + 8 + 1 + 32
    assert blobs.decode_one(le)[0] == [2, 2] and blobs.decode_one(le)[1] is True
    be = blobs.encode_matrix(x, (4,), False, "big")[0].as_py()
    assert be[:4] == (1).to_bytes(4, "big") and be[8:12] == (4).to_bytes(4, "big")
    assert np.allclose(blobs.decode_one(be, "big")[2], x[0])
    with pytest.raises(ValueError):
        blobs.decode_one(le + b"\x00")           # trailing bytes
    with pytest.raises(ValueError):
        blobs.decode_one((0).to_bytes(4, "little") + b"\x01")  # rank 0


def test_blob_roundtrip_mixed_shapes(spark):
    df = spark.createDataFrame([(0, [1.0, 2.0]), (1, [3.0, 4.0])], "id long, vec array<double>")
    enc = blobs.encode(df, "vec", (2,))
    dec = blobs.decode(enc, "blob").orderBy("id").collect()
    assert [list(r.data) for r in dec] == [[1.0, 2.0], [3.0, 4.0]] and dec[0].shape == [2]


def test_label_codec_and_row_key(spark):
    df = spark.createDataFrame([(v,) for v in (0, 7, 255, 65536, -1, -2, -2147483648, 2147483647)], "x int")
    out = df.select("x", kv.encode_be_int32("x").alias("b")).select("x", "b", kv.decode_be_int32("b").alias("y"))
    for r in out.collect():
        assert r.x == r.y and bytes(r.b) == int(r.x).to_bytes(4, "big", signed=True)
    keys = spark.createDataFrame([(5,), (123456,)], "i long").select(kv.row_key("i").alias("k")).collect()
    assert [r.k for r in keys] == ["train_00005", "train_123456"]


def test_required_columns_fail_and_report(spark):
    df = spark.createDataFrame([("a", b"x", None), ("b", None, None), ("c", b"y", b"\x00\x00\x00\x01")],
                               "row_key string, image binary, label binary")
    r = kv.missing_report(df).first()
    assert (r.missing_image, r.missing_label, r.missing_any, r.rows) == (1, 2, 2, 3)
    with pytest.raises(Exception):
        kv.require_columns(df).collect()


def test_upsert_newest_wins(spark):
    old = spark.createDataFrame([("k1", 0, 1), ("k2", 0, 2)], "row_key string, version int, label int")
    new = spark.createDataFrame([("k2", 1, 20), ("k3", 1, 30)], "row_key string, version int, label int")
    got = {r.row_key: (r.version, r.label) for r in kv.upsert(old, new).collect()}
    assert got == {"k1": (0, 1), "k2": (1, 20), "k3": (1, 30)}


def test_idx_files_roundtrip(spark):
    d = tempfile.mkdtemp(prefix="tg-idx-")
    rng = np.random.default_rng(0)
    imgs = rng.integers(0, 256, size=(5, 2, 3), dtype=np.uint8)
    labs = np.array([3, 1, 4, 1, 5], dtype=np.uint8)
    with open(os.path.join(d, "s0-images.idx.gz"), "wb") as f:
        f.write(idx.encode_idx("images", imgs.reshape(5, -1), 2, 3))
    with open(os.path.join(d, "s0-labels.idx.gz"), "wb") as f:
        f.write(idx.encode_idx("labels", labs))
    recs = idx.read_idx(spark, d)
    paired = idx.pair_images_labels(recs).orderBy("idx").collect()
    assert [r.label for r in paired] == labs.tolist()
    assert [bytes(r.pixels) for r in paired] == [im.tobytes() for im in imgs.reshape(5, -1)]
    with pytest.raises(ValueError):
        idx.parse_idx(gzip.compress((1234).to_bytes(4, "big")))


def test_idx_count_mismatch_fails(spark):
    d = tempfile.mkdtemp(prefix="tg-idx-")
    with open(os.path.join(d, "s1-images.idx.gz"), "wb") as f:
        f.write(idx.encode_idx("images", np.zeros((2, 4), dtype=np.uint8), 2, 2))
    with open(os.path.join(d, "s1-labels.idx.gz"), "wb") as f:
        f.write(idx.encode_idx("labels", np.zeros(3, dtype=np.uint8)))
    with pytest.raises(Exception, match="counts differ"):  # found by the job itself, no job runs while the plan is built
        idx.pair_images_labels(idx.read_idx(spark, d)).collect()


def test_loss_log_utf16_files(spark):
    d = tempfile.mkdtemp(prefix="tg-log-")
    lines_a = ["Partition 0: avg batch loss = 2.5", "noise", "Partition 1: avg batch loss = 2.25",
               "Partition 0: avg batch loss = 2.0"]
    lines_b = ["Partition 1: avg batch loss = 1.5", "Partition 0: avg batch loss = 1.0"]
    for name, lines in (("a.log", lines_a), ("b.log", lines_b)):
        with open(os.path.join(d, name), "wb") as f:
            f.write("\n".join(lines).encode("utf-16"))
    c = losslog.curve(losslog.parse(losslog.read_lines(spark, d, "UTF-16")))
    got = sorted((r.part, r.step, r.loss) for r in c.collect())
    assert got == [(0, 1, 2.5), (0, 2, 2.0), (0, 3, 1.0), (1, 1, 2.25), (1, 2, 1.5)]
    s = {r.part: r for r in losslog.series_summary(c).collect()}
    assert s[0].first_loss == 2.5 and s[0].last_loss == 1.0 and s[1].steps == 2
