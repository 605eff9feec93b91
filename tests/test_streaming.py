"""Structured Streaming: the loss monitor picks up new log files; streaming scoring equals batch scoring."""

import os
import tempfile

import numpy as np
from pyspark.sql import types as T

from tablegrad.operators import nn
from tablegrad.streaming import monitor


def test_loss_monitor_updates_with_new_files(spark):
    d = tempfile.mkdtemp(prefix="tg-stream-")
    with open(os.path.join(d, "a.log"), "w") as f:
        f.write("Partition 0: avg batch loss = 2.0\nPartition 1: avg batch loss = 3.0\n")
    q = monitor.start_loss_monitor(spark, d, "tg_loss_monitor", checkpoint=tempfile.mkdtemp(prefix="tg-ck-"))
    try:
        q.processAllAvailable()
        first = {r.part: (r.steps, r.last_loss) for r in spark.sql("SELECT * FROM tg_loss_monitor").collect()}
        assert first == {0: (1, 2.0), 1: (1, 3.0)}
        with open(os.path.join(d, "b.log"), "w") as f:
            f.write("Partition 0: avg batch loss = 1.5\n")
        q.processAllAvailable()
        second = {r.part: (r.steps, r.last_loss, r.min_loss) for r in spark.sql("SELECT * FROM tg_loss_monitor").collect()}
        assert second[0] == (2, 1.5, 1.5) and second[1] == (1, 3.0, 3.0)
    finally:
        q.stop()


def test_score_stream_matches_batch(spark):
    d = tempfile.mkdtemp(prefix="tg-score-")
    rng = np.random.default_rng(0)
    schema = T.StructType([T.StructField("row_id", T.LongType()), T.StructField("features", T.ArrayType(T.DoubleType()))])
    data = [(i, rng.normal(size=4).tolist()) for i in range(20)]
    spark.createDataFrame(data, schema).write.mode("overwrite").parquet(d + "/part1")
    layers = nn.mlp([4, 3, 2], softmax_output=True)
    params = nn.init_params_np(layers, 1)
    s = monitor.score_stream(spark, d + "/part1", schema, layers, params)
    q = s.writeStream.format("memory").queryName("tg_scores").outputMode("append").start()
    try:
        q.processAllAvailable()
        got = {r.row_id: r.output for r in spark.sql("SELECT * FROM tg_scores").collect()}
    finally:
        q.stop()
    assert len(got) == 20
    for i, x in data:
        h = np.maximum(np.array(x) @ params[0] + params[1], 0)
        z = h @ params[2] + params[3]
        p = np.exp(z - z.max()) / np.exp(z - z.max()).sum()
        assert np.allclose(got[i], p)
