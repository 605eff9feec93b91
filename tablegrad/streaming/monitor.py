"""Structured Streaming views of training: a live loss monitor and streaming batch scoring.

The loss monitor tails a directory of training logs (each new file is picked up once): lines are parsed exactly
as the batch source does, and a per-partition aggregate (steps, first / last / min / mean loss) is kept as
streaming state. Scoring applies a model's forward pass to a stream of sample files; it is stateless, so it
runs in append mode with no watermark.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tablegrad.operators.nn import forward_rows
from tablegrad.session import scratch_path
from tablegrad.sources import losslog


BINARY_FILE_SCHEMA = T.StructType([
    T.StructField("path", T.StringType()), T.StructField("modificationTime", T.TimestampType()),
    T.StructField("length", T.LongType()), T.StructField("content", T.BinaryType())])


def loss_monitor(spark: SparkSession, log_dir: str, encoding: str = "UTF-8", glob: str = "*", max_files: int = 64) -> DataFrame:
    """Streaming DataFrame: ``(part, steps, first_loss, last_loss, min_loss, mean_loss)``.

    Order inside the stream is (file name, line number), so "last" is the latest line of the latest file.
    """
    files = (spark.readStream.format("binaryFile").schema(BINARY_FILE_SCHEMA).option("pathGlobFilter", glob)
             .option("maxFilesPerTrigger", max_files).load(log_dir).select("path", "content"))
    parsed = losslog.parse(losslog.lines_from_files(files, encoding))
    order = F.struct("file", "line_no")
    return parsed.groupBy("part").agg(F.count("*").alias("steps"), F.min_by("loss", order).alias("first_loss"),
                                      F.max_by("loss", order).alias("last_loss"), F.min("loss").alias("min_loss"),
                                      F.avg("loss").alias("mean_loss"))


def start_loss_monitor(spark: SparkSession, log_dir: str, query_name: str, encoding: str = "UTF-8",
                       checkpoint: str | None = None, sink: str = "memory") -> StreamingQuery:
    """Run the monitor in complete mode; the checkpoint lives under the shared ``spark.checkpoint.dir``."""
    ckpt = checkpoint or scratch_path(spark, f"stream-{query_name}")
    return (loss_monitor(spark, log_dir, encoding).writeStream.outputMode("complete").format(sink)
            .queryName(query_name).option("checkpointLocation", ckpt).start())


def score_stream(spark: SparkSession, samples_dir: str, schema: T.StructType, layers, params, id_col: str = "row_id",
                 features: str = "features") -> DataFrame:
    """Streaming forward pass over Parquet sample files: ``(id, output ARRAY<DOUBLE>)``."""
    src = spark.readStream.schema(schema).parquet(samples_dir)
    return forward_rows(src, layers, params, features, "output", [id_col])
