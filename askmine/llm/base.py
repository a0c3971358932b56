"""What the training-data operators share: table access, lineage cuts and Arrow text buffers."""

from __future__ import annotations

import ctypes
import gc
import re
import sys
import tempfile
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

_LIBC = ctypes.CDLL(None) if sys.platform == "linux" and hasattr(ctypes.CDLL(None), "malloc_trim") else None


def release() -> None:
    """Give freed memory back to the system: Python workers live on, with the next task's needs on top of the last one's."""
    gc.collect(0)
    pa.default_memory_pool().release_unused()
    if _LIBC is not None:
        _LIBC.malloc_trim(0)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def checkpointed(df: DataFrame) -> DataFrame:
    """Cut the lineage with a reliable checkpoint in the folder that the session names, which all executors must share.

    Where none is named, a temporary folder serves a session of one process; on a cluster that is an error.
    """
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        folder = df.sparkSession.conf.get("spark.checkpoint.dir", None)
        if not folder and re.fullmatch(r"local(\[.*\])?", context.master) is None:
            raise ValueError("spark.checkpoint.dir is not set: it names a folder that driver and executors share")
        context.setCheckpointDir(folder or tempfile.mkdtemp(prefix="checkpoints-"))
    return df.checkpoint(eager=True)


def quoted(name: str) -> str:
    """A column's name as Spark reads it back, whatever characters it has."""
    return "`" + name.replace("`", "``") + "`"


def row_of(docs: DataFrame, *without: str) -> Column:
    """A struct ``row`` of a row's columns, whatever their names."""
    return F.struct(*[F.col(quoted(c)) for c in docs.columns if c not in without]).alias("row")


def with_fields(fields: Iterable[StructField], more: str) -> StructType:
    """A schema of some fields and those that a DDL string names."""
    return StructType([*fields, *StructType.fromDDL(more).fields])


#: A key that more than this share of all rows have is joined by broadcast: there are HOT_SHARE such keys at most.
HOT_SHARE = 1000


def joined_hot(rows: DataFrame, table: DataFrame, on: str, n_rows: int, count: str) -> DataFrame:
    """rows joined with table, whose keys are unique and which says in ``count`` how many rows have each (the column goes).

    The keys of over 1/HOT_SHARE of n_rows rows, of which there are HOT_SHARE at most, are broadcast, so that a key that a
    third of all rows have doesn't make one task join them all; the others are joined by a shuffle.
    """
    others = [c for c in table.columns if c not in (on, count)]
    is_hot = F.col(count) * HOT_SHARE > F.lit(n_rows)
    marked = rows.join(F.broadcast(table.filter(is_hot).select(on, *others, F.lit(True).alias("_hot"))), on, "left")
    columns = [*rows.columns, *others]
    cold = marked.filter(F.col("_hot").isNull()).select(*rows.columns).join(table.filter(~is_hot).select(on, *others), on)
    return marked.filter("_hot").select(*columns).union(cold.select(*columns))


def total_bytes(docs: DataFrame, text: str = "text") -> tuple[int, int]:
    """Rows and UTF-8 bytes of the texts: one native aggregate, two numbers to the driver."""
    row = docs.agg(F.count(F.lit(1)).alias("n"), F.sum(F.octet_length(F.col(quoted(text)).cast("string"))).alias("b")).first()
    return int(row["n"]), int(row["b"] or 0)


def blocks_for(n_bytes: int, block_bytes: int) -> int:
    """How many blocks of about block_bytes hold n_bytes; grows with the input, at least 1."""
    return max(1, -(-n_bytes // block_bytes))


def block_of(key: Column, n_blocks: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(n_blocks)).cast("int")


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string or binary array without a copy; a null is an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
        if isinstance(column, pa.ChunkedArray):
            column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], pa.string())
    if column.null_count:
        column = column.fill_null("" if pa.types.is_string(column.type) or pa.types.is_large_string(column.type) else b"")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    ends = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw, ends


def texts_of(column: pa.Array) -> list[str]:
    """The texts as Python strings; a null is an empty text."""
    return [t or "" for t in column.to_pylist()]


def row_blocks(sizes: Iterable[int], limit: int) -> Iterator[tuple[int, int]]:
    """Consecutive row ranges whose sizes sum to limit at most; a row above it stands alone."""
    start = total = 0
    i = -1
    for i, size in enumerate(sizes):
        if i > start and total + size > limit:
            yield start, i
            start, total = i, 0
        total += size
    if i >= start and i >= 0:
        yield start, i + 1
