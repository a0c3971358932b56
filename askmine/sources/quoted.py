"""Quoted CSV files by byte ranges: records that span lines are split like any others, and each knows the line it starts on.

A byte lies inside quotes if the quotes before it are odd in number (a doubled quote counts twice). So one pass counts the
quotes and line ends of each range, their sums over the ranges before it say how a range begins, and a second pass reads the
records that start in each range. No file is read whole by one task. Lines end in \\n or \\r\\n; a quote inside a field
that isn't quoted isn't known to this format. Blank lines are no records. An empty file has no rows.
"""

from __future__ import annotations

import csv
import io
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from askmine.sources.files import opened

RANGE_BYTES, BLOCK = 64 << 20, 1 << 16
RECORD = "file string, line bigint, fields array<string>"


def byte_ranges(path: str, extension: str = "csv", size: int = RANGE_BYTES) -> list[tuple[str, int, int]]:
    """(path, start, stop) of the ranges of a file, or of the files of a folder."""
    system, own = opened(path)
    info = system.get_file_info(own)
    if info.type == fs.FileType.NotFound:
        return []
    if info.type == fs.FileType.File:
        return [(path, a, min(a + size, info.size)) for a in range(0, info.size, size)]
    inside = sorted((x for x in system.get_file_info(fs.FileSelector(own, recursive=True)) if x.is_file and x.extension == extension), key=lambda x: x.path)
    named = [(path.rstrip("/") + x.path[len(own.rstrip("/")) :], x.size) for x in inside]
    return [(name, a, min(a + size, total)) for name, total in named for a in range(0, total, size)]


def _read(path: str, start: int, stop: int) -> bytes:
    system, own = opened(path)
    with system.open_input_file(own) as f:
        f.seek(start)
        return f.read(stop - start)


def record_ends(data: bytes, inside: bool) -> np.ndarray:
    """Places behind the line ends that lie outside quotes."""
    raw = np.frombuffer(data, np.uint8)
    quotes = np.cumsum(raw == ord('"')) + inside
    return np.flatnonzero((raw == ord("\n")) & (quotes % 2 == 0)) + 1


def records(path: str, start: int, stop: int, inside: bool, lines: int) -> Iterator[tuple[int, list[str]]]:
    """(line, fields) of the records that start in [start, stop); inside: whether a quote is open there; lines: line ends before."""
    data = _read(path, start, stop)
    ends = record_ends(data, inside)
    if start == 0:
        first = 0
    else:  # a record starts here only where one has ended just before
        before = _read(path, start - 1, start) == b"\n" and not inside
        first = 0 if before else int(ends[0]) if len(ends) else len(data)
    if first >= len(data):
        return
    if not len(ends) or ends[-1] < len(data):  # the last record goes on behind the range
        inside, at = bool((data.count(b'"') + inside) % 2), stop
        parts = [data]
        while more := _read(path, at, at + BLOCK):
            ends = record_ends(more, inside)
            parts.append(more[: ends[0]] if len(ends) else more)
            if len(ends):
                break
            inside, at = bool((more.count(b'"') + inside) % 2), at + BLOCK
        data = b"".join(parts)
    line = lines + data[:first].count(b"\n") + 1
    reader = csv.reader(io.StringIO(data[first:].decode("utf-8", "replace"), newline=""))
    done = 0
    for fields in reader:
        if fields:
            yield line + done, fields
        done = reader.line_num


def read(spark: SparkSession, path: str, extension: str = "csv", size: int = RANGE_BYTES) -> DataFrame:
    """file, line, fields of every record of a file or of a folder's files, headers among them."""
    found = byte_ranges(path, extension, size)
    ranges = spark.createDataFrame([(k, *r) for k, r in enumerate(found)], "k bigint, file string, start bigint, stop bigint").repartition(max(1, min(len(found), 4096)), "k")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data = [_read(*r) for r in zip(*(c.to_pylist() for c in batch.columns[1:4]))] if batch.num_rows else []
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([d.count(b'"') for d in data], pa.int64()), pa.array([d.count(b"\n") for d in data], pa.int64())], [*batch.schema.names, "quotes", "ends"])

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file, start, stop, quotes, ends in zip(*(c.to_pylist() for c in batch.columns)):
                rows = list(records(file, start, stop, bool(quotes % 2), ends))
                columns = zip(*rows) if rows else ([], [])
                line, fields = (pa.array(list(c), t) for c, t in zip(columns, (pa.int64(), pa.list_(pa.string()))))
                yield pa.RecordBatch.from_arrays([pa.array([file] * len(rows), pa.string()), line, fields], ["file", "line", "fields"])

    before = W.partitionBy("file").orderBy("start").rowsBetween(W.unboundedPreceding, -1)  # a row a range
    counted = ranges.mapInArrow(count, "k bigint, file string, start bigint, stop bigint, quotes bigint, ends bigint")
    known = counted.withColumns({c: F.coalesce(F.sum(c).over(before), F.lit(0)) for c in ("quotes", "ends")})
    spread = known.select("file", "start", "stop", "quotes", "ends").repartition(max(1, min(len(found), 4096)), "file", "start")
    return spread.mapInArrow(parse, RECORD)


def with_header(rows: DataFrame, columns: str) -> DataFrame:
    """file, line and the columns of a DDL string, by the names that each file's first record gives; an absent or empty field is null."""
    head = rows.groupBy("file").agg(F.min_by("fields", "line").alias("_names"), F.min("line").alias("_first"))  # a row a file
    named = rows.join(head, "file").filter(F.col("line") > F.col("_first"))
    value = lambda name: F.nullif(F.get("fields", (F.array_position("_names", F.lit(name)) - 1).cast("int")), F.lit(""))
    present = lambda name: F.when(F.array_contains("_names", name), value(name))
    made = [present(c.split(" ")[0]).try_cast(c.split(" ", 1)[1]).alias(c.split(" ")[0]) for c in columns.split(", ")]
    return named.select("file", "line", *made)
