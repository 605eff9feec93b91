"""Large files by ranges: text lines by byte ranges, IDX records by record ranges, as Python data sources.

A file of any size is read by ranges in many tasks, each holding one chunk; a partition is a range, or several where there are many small
ones. A line belongs to the range in which it begins; ranges of UTF-16 files begin at whole code units. Gzip files don't split: each
is one range, read as a stream. Files are opened by ``pyarrow.fs``, so a path may be local or the URI of any store that it knows.

``put_files`` is the way back: rows ``(path, content)`` become files of those names.
"""

from __future__ import annotations

import fnmatch
import itertools
import os
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from tablegrad.functions.arrow import column
from tablegrad.sources.idx import IMAGE_MAGIC, LABEL_MAGIC, RECORD_SCHEMA, shard_name

#: Bytes of a range and of one read.
RANGE_BYTES = 32 << 20
CHUNK = 1 << 20
#: Partitions of many small ranges, and the bytes that opening one counts as.
TASKS = 128
OPEN_BYTES = 64 << 10
#: Bytes read first beyond a range, for the rest of its last line, and rows of one batch of lines.
TAIL = 1 << 10
BATCH = 8192
LINES = "file string, range bigint, place bigint, line string"


def open_store(path: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a path, and the path there."""
    if path.startswith("file:"):
        return pafs.LocalFileSystem(), "/" + path[5:].lstrip("/")
    return pafs.FileSystem.from_uri(path) if "://" in path else (pafs.LocalFileSystem(), os.path.abspath(path))


def list_files(path: str, pattern: str) -> list[tuple[str, int]]:
    """(path, size) of a file, or of the files of a folder whose names fit, in order of their names; hidden ones are left out."""
    fs, at = open_store(path)
    info = fs.get_file_info(at)
    if info.type == pafs.FileType.File:
        return [(at, info.size)]
    if info.type == pafs.FileType.NotFound:
        raise FileNotFoundError(path)
    found = fs.get_file_info(pafs.FileSelector(at))
    names = lambda i: not i.base_name.startswith(("_", ".")) and any(fnmatch.fnmatch(i.base_name, p) for p in pattern.split("|"))
    return sorted((i.path, i.size) for i in found if i.type == pafs.FileType.File and names(i))


class Range:
    """A part of a file; ``size``: its bytes."""

    def __init__(self, path: str, number: int, begin: int, end: int, size: int, **more):
        self.path, self.number, self.begin, self.end, self.size, self.more = path, number, begin, end, size, more


class Ranges(InputPartition):
    def __init__(self, ranges: list[Range]):
        super().__init__(0)
        self.ranges = ranges

    def by_file(self) -> Iterator[tuple[str, list[Range]]]:
        return ((path, list(own)) for path, own in itertools.groupby(self.ranges, lambda r: r.path))


def deal(found: list[Range]) -> list[Ranges]:
    """Neighbouring ranges share a partition, so that many small ones don't make as many tasks: there are ``TASKS`` partitions, or more once
    each has ``RANGE_BYTES``; fewer ranges have one each."""
    if not found:
        return [Ranges([])]
    cost = np.cumsum([r.size + OPEN_BYTES for r in found])
    tasks = max(TASKS, -(-int(cost[-1]) // RANGE_BYTES))
    if len(found) <= tasks:
        return [Ranges([r]) for r in found]
    task = (cost - 1) * tasks // int(cost[-1])
    cuts = [0, *(np.flatnonzero(np.diff(task)) + 1).tolist(), len(found)]
    return [Ranges(found[x:y]) for x, y in zip(cuts, cuts[1:])]


class _Reader(DataSourceReader):
    def __init__(self, options: dict):
        self.path, self.pattern = options["path"], options.get("pattern", "*")
        self.bytes = int(options.get("rangebytes", RANGE_BYTES))
        self.options = options


# ---------------------------------------------------------------- text lines
_ENCODINGS = {"utf-8": ("utf-8", b"\n"), "utf-16le": ("utf-16-le", b"\n\0"), "utf-16be": ("utf-16-be", b"\0\n")}


def _encoding(name: str, first: bytes) -> tuple[str, bytes, int]:
    """(codec, line feed, bytes of the byte order mark) of a file that begins with ``first``."""
    key = name.lower().replace("_", "-").replace("utf-16-", "utf-16").replace("utf8", "utf-8")
    if key == "utf-16":  # the mark decides; big-endian without one
        key = "utf-16le" if first[:2] == b"\xff\xfe" else "utf-16be"
    if key not in _ENCODINGS:
        raise ValueError(f"lines: unknown encoding {name}")
    codec, feed = _ENCODINGS[key]
    mark = {"utf-8": b"\xef\xbb\xbf", "utf-16-le": b"\xff\xfe", "utf-16-be": b"\xfe\xff"}[codec]
    return codec, feed, len(mark) if first.startswith(mark) else 0


def _find(data: bytes, feed: bytes, at: int) -> int:
    """The first line feed at or after ``at`` that begins at a whole code unit, or -1."""
    i = data.find(feed, at)
    while i >= 0 and i % len(feed):
        i = data.find(feed, i + 1)
    return i


def _rfind(data: bytes, feed: bytes) -> int:
    """The last line feed that begins at a whole code unit, or -1."""
    i = data.rfind(feed)
    while i >= 0 and i % len(feed):
        i = data.rfind(feed, 0, i + len(feed) - 1)
    return i


def _range_lines(f: pa.NativeFile, size: int, codec: str, feed: bytes, mark: int, part: Range) -> Iterator[list[str]]:
    """The lines that begin in a range, some at a time; what is held is a chunk and a line."""
    unit = len(feed)
    at = base = max(part.begin - unit, 0)  # one unit back: a line feed there means that a line begins with the range
    held, skip, tail = b"", part.begin > 0, TAIL

    def lines(end: int) -> list[str]:
        text = held[0 if base else mark:end].decode(codec)
        return [x[:-1] if x.endswith("\r") else x for x in text.split("\n")]

    while base < part.end:
        want = part.end - at
        if want < tail:
            want, tail = tail, tail * 2
        new = f.read_at(min(CHUNK, size - at, want), at)
        at += len(new)
        held += new
        if skip:
            i = _find(held, feed, 0)
            cut = len(held) - len(held) % unit if i < 0 else i + unit
            held, base, skip = held[cut:], base + cut, i < 0
            if skip and at >= size:
                return
            if skip or base >= part.end:
                continue
        end = _find(held, feed, max(part.end - unit - base, 0))  # of the last line
        if end >= 0 or at >= size:
            yield lines(end if end >= 0 else len(held))  # at the end of the file without a line feed
            return
        end = _rfind(held, feed)
        if end >= 0:
            yield lines(end)
            held, base = held[end + unit:], base + end + unit


class LineReader(_Reader):
    def partitions(self):
        step = max(2, self.bytes - self.bytes % 2)
        return deal([Range(path, k, a, min(size, a + step), min(step, size - a)) for path, size in list_files(self.path, self.pattern)
                     for k, a in enumerate(range(0, size, step))])

    def read(self, part: Ranges) -> Iterator[pa.RecordBatch]:
        fs, _ = open_store(self.path)
        held, rows, chars = [], 0, 0  # (path, number, first place, lines)

        def batch() -> pa.RecordBatch:
            n = [len(x) for *_, x in held]
            return pa.RecordBatch.from_arrays(
                [pa.array([p for (p, *_), m in zip(held, n) for _ in range(m)], pa.string()), pa.array(np.repeat([k for _, k, *_ in held], n), pa.int64()),
                 pa.array(np.concatenate([np.arange(first, first + m) for (*_, first, _), m in zip(held, n)])),
                 pa.array([x for *_, own in held for x in own], pa.string())], names=["file", "range", "place", "line"])

        for path, own in part.by_file():
            with fs.open_input_file(path) as f:
                size = f.size()
                codec, feed, mark = _encoding(self.options.get("encoding", "UTF-8"), f.read_at(min(3, size), 0))
                for r in own:
                    place = 0
                    for lines in _range_lines(f, size, codec, feed, mark, r):
                        held.append((path, r.number, place, lines))
                        place, rows, chars = place + len(lines), rows + len(lines), chars + sum(map(len, lines))
                        if rows >= BATCH or chars >= CHUNK:
                            yield batch()
                            held, rows, chars = [], 0, 0
        if held:
            yield batch()


class LineSource(DataSource):
    """Options: path, pattern (names, ``*`` by default, ``|`` between several), encoding (UTF-8, UTF-16, UTF-16LE, UTF-16BE), rangeBytes."""

    @classmethod
    def name(cls):
        return "tablegrad_lines"

    def schema(self):
        return LINES

    def reader(self, schema):
        return LineReader(dict(self.options))


def read_lines(spark: SparkSession, path: str, encoding: str = "UTF-8", pattern: str = "*", range_bytes: int = RANGE_BYTES) -> DataFrame:
    """``(file, range, place, line)``: the lines that begin in each range, numbered from 0 in it."""
    spark.dataSource.register(LineSource)
    return spark.read.format("tablegrad_lines").option("path", path).option("encoding", encoding).option("pattern", pattern).option(
        "rangeBytes", range_bytes).load()


def number_lines(lines: DataFrame) -> DataFrame:
    """``(file, line_no, line)``: line numbers from a counting pass over the ranges (one row a range is shuffled)."""
    counts = lines.groupBy("file", "range").agg(F.count("*").alias("_n"))
    before = Window.partitionBy("file").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("file", "range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    return lines.join(offsets, ["file", "range"]).select("file", (F.col("_off") + F.col("place")).alias("line_no"), "line")


def curve(lines: DataFrame) -> DataFrame:
    """Loss curves ``(part, step, loss)`` of log lines by range: the step of a line is its number among the lines of its part, in the
    order of files, ranges and places. A window holds one part's lines of one range; offsets come from counts."""
    from tablegrad.sources.losslog import LINE_PATTERN
    m = lines.select("file", "range", "place", F.regexp_extract("line", LINE_PATTERN, 1).alias("_p"), F.regexp_extract("line", LINE_PATTERN, 2).alias("_l"))
    rows = m.where("_p <> ''").select("file", "range", "place", F.col("_p").cast("int").alias("part"), F.col("_l").cast("double").alias("loss"))
    counts = rows.groupBy("part", "file", "range").agg(F.count("*").alias("_n"))
    before = Window.partitionBy("part").orderBy("file", "range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("part", "file", "range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    own = F.row_number().over(Window.partitionBy("part", "file", "range").orderBy("place"))
    return rows.withColumn("_r", own).join(offsets, ["part", "file", "range"]).select("part", (F.col("_off") + F.col("_r")).cast("int").alias("step"), "loss")


# ---------------------------------------------------------------- IDX records
def _header(head: bytes) -> tuple[str, int, int, int]:
    """(kind, records, bytes of a record, bytes of the header)."""
    numbers = [int.from_bytes(head[i:i + 4], "big") for i in range(0, 16, 4)]
    if len(head) >= 16 and numbers[0] == IMAGE_MAGIC:
        return "images", numbers[1], numbers[2] * numbers[3], 16
    if len(head) >= 8 and numbers[0] == LABEL_MAGIC:
        return "labels", numbers[1], 1, 8
    raise ValueError(f"idx: unknown magic {numbers[0] if len(head) >= 4 else head!r}")


def _records(path: str, kind: str, first: int, raw: bytes, width: int) -> pa.RecordBatch:
    n = len(raw) // width if width else 0
    fields = [pa.array([path] * n, pa.string()), pa.array([kind] * n, pa.string()), pa.array([shard_name(path)] * n, pa.string()),
              pa.array(np.arange(first, first + n, dtype=np.int64))]
    if kind == "images":
        offsets = np.arange(0, (n + 1) * width, width, dtype=np.int32)
        fields += [pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer(offsets), pa.py_buffer(raw)]), pa.nulls(n, pa.int32())]
    else:
        fields += [pa.nulls(n, pa.binary()), pa.array(np.frombuffer(raw, np.uint8).astype(np.int32))]
    return pa.RecordBatch.from_arrays(fields, names=[f.name for f in RECORD_SCHEMA.fields])


class IdxReader(_Reader):
    def partitions(self):
        fs, _ = open_store(self.path)
        out = []
        for path, size in list_files(self.path, self.pattern):
            with fs.open_input_file(path) as f:
                head = f.read_at(min(16, size), 0)
            if head[:2] == b"\x1f\x8b":
                out.append(Range(path, 0, 0, size, size, gzip=True))
                continue
            kind, n, width, skip = _header(head)
            if size != skip + n * width:
                raise ValueError(f"idx: {path}: payload size mismatch")
            step = max(1, self.bytes // max(1, width))
            out += [Range(path, k, a, min(n, a + step), (min(n, a + step) - a) * width, gzip=False, kind=kind, width=width, skip=skip)
                    for k, a in enumerate(range(0, n, step))]
        return deal(out)

    def read(self, part: Ranges) -> Iterator[pa.RecordBatch]:
        fs, _ = open_store(self.path)
        for path, own in part.by_file():
            with fs.open_input_file(path) as f:
                for r in own:
                    if r.more["gzip"]:
                        yield from self._stream(f, path)
                        continue
                    kind, width, skip = r.more["kind"], r.more["width"], r.more["skip"]
                    step = max(1, CHUNK // max(1, width))
                    for a in range(r.begin, r.end, step):
                        b = min(r.end, a + step)
                        yield _records(path, kind, a, f.read_at((b - a) * width, skip + a * width), width)

    @staticmethod
    def _stream(f, path: str) -> Iterator[pa.RecordBatch]:
        """Records of a gzip file: what is held is one chunk of it, unpacked."""
        unzip, held, head, done = zlib.decompressobj(31), b"", None, 0
        packed = f.read(CHUNK)
        while packed or unzip.unconsumed_tail:
            held += unzip.decompress(unzip.unconsumed_tail + packed, CHUNK)
            if unzip.eof and unzip.unused_data:  # another member follows
                packed, unzip = unzip.unused_data, zlib.decompressobj(31)
                continue
            if head is None and (len(held) >= 16 or (unzip.eof and held)):
                head = _header(held[:16])
                held = held[head[3]:]
            if head and head[2]:
                cut = len(held) - len(held) % head[2]
                if cut:
                    yield _records(path, head[0], done, held[:cut], head[2])
                    done, held = done + cut // head[2], held[cut:]
            packed = b"" if unzip.unconsumed_tail else f.read(CHUNK)
        if head is None or done != (head[1] if head[2] else 0) or held or not unzip.eof:
            raise ValueError(f"idx: {path}: payload size mismatch")


class IdxSource(DataSource):
    """Options: path, pattern, rangeBytes."""

    @classmethod
    def name(cls):
        return "tablegrad_idx"

    def schema(self):
        return RECORD_SCHEMA

    def reader(self, schema):
        return IdxReader(dict(self.options))


def read_idx(spark: SparkSession, path: str, pattern: str = "*idx*|*ubyte*", range_bytes: int = RANGE_BYTES) -> DataFrame:
    """A folder of IDX files, plain (by record ranges) or gzip (as streams) -> ``(path, kind, shard, idx, pixels, label)``."""
    spark.dataSource.register(IdxSource)
    return spark.read.format("tablegrad_idx").option("path", path).option("pattern", pattern).option("rangeBytes", range_bytes).load()


# ---------------------------------------------------------------- files from rows
def put_files(files: DataFrame, folder: str) -> DataFrame:
    """Write rows ``(path, content)`` as files of those names in ``folder`` -> their paths and sizes (lazy: run it). A file appears under its
    name when it is complete, so a task that runs again does no harm."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, at = open_store(folder)
        fs.create_dir(at, recursive=True)
        for b in batches:
            sizes = []
            for name, content in zip(column(b, "path").to_pylist(), column(b, "content")):
                part = f"{at}/.{name}.{uuid.uuid4().hex}"
                with fs.open_output_stream(part) as f:
                    f.write(content.as_buffer())
                fs.move(part, f"{at}/{name}")
                sizes.append(len(content.as_buffer()))
            yield pa.RecordBatch.from_arrays([column(b, "path"), pa.array(sizes, pa.int64())], names=["path", "bytes"])

    return files.select("path", "content").mapInArrow(run, "path string, bytes bigint")
