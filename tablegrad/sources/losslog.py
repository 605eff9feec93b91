"""Training-log source: lines ``Partition <int>: avg batch loss = <decimal>`` -> per-partition loss curves.

Files are read whole with ``binaryFile`` (optionally decoded from UTF-16), split into numbered lines, and parsed
with ``regexp_extract``. The step of a line is its occurrence number within its partition id in file order. It is
computed without a window over a whole partition: per (file, part) line counts (a small table) give each file's
offset, and the rank inside one file is a window over that file only, which a single task already holds.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

LINE_PATTERN = r"Partition\s+(\d+): avg batch loss = ([0-9.]+)"  # fixed value: the log line format
LINE_FORMAT = "Partition %d: avg batch loss = %.6f"               # fixed value: how such lines are printed


def format_line(part, loss):
    return F.format_string(LINE_FORMAT, part, loss)


def read_lines(spark: SparkSession, path: str, encoding: str = "UTF-8", glob: str | None = None) -> DataFrame:
    """-> ``(file, line_no, line)``; files are ordered by name, lines by position."""
    r = spark.read.format("binaryFile")
    if glob:
        r = r.option("pathGlobFilter", glob)
    files = r.load(path).select("path", "content")
    return lines_from_files(files, encoding)


def lines_from_files(files: DataFrame, encoding: str = "UTF-8") -> DataFrame:
    text = F.decode(F.col("content"), encoding)
    return (files.select(F.col("path").alias("file"), F.posexplode(F.split(text, "\r?\n")).alias("line_no", "line"))
            .where(F.length("line") > 0))


def parse(lines: DataFrame) -> DataFrame:
    """Keep matching lines: ``(file, line_no, part, loss)``."""
    m = lines.select("file", "line_no",
                     F.regexp_extract("line", LINE_PATTERN, 1).alias("_p"),
                     F.regexp_extract("line", LINE_PATTERN, 2).alias("_l"))
    return m.where(F.col("_p") != "").select("file", "line_no", F.col("_p").cast("int").alias("part"),
                                             F.col("_l").cast("double").alias("loss"))


def curve(parsed: DataFrame) -> DataFrame:
    """``(part, step, loss)`` with step = 1-based occurrence number of the partition id in file order."""
    per_file = parsed.groupBy("file", "part").agg(F.count("*").alias("_cnt"))
    offsets = per_file.withColumn(
        "_off", F.coalesce(F.sum("_cnt").over(Window.partitionBy("part").orderBy("file")
                                              .rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    local = parsed.withColumn("_r", F.row_number().over(Window.partitionBy("file", "part").orderBy("line_no")))
    return (local.join(offsets.select("file", "part", "_off"), ["file", "part"])
            .select("part", (F.col("_off") + F.col("_r")).cast("int").alias("step"), "loss"))


def series_summary(c: DataFrame) -> DataFrame:
    """Per partition: number of points, first / last / min / max / mean loss."""
    return c.groupBy("part").agg(F.count("*").cast("int").alias("steps"),
                                 F.min_by("loss", "step").alias("first_loss"),
                                 F.max_by("loss", "step").alias("last_loss"),
                                 F.min("loss").alias("min_loss"), F.max("loss").alias("max_loss"),
                                 F.avg("loss").alias("mean_loss"))
