"""Arrow UDFs of texts that hold the Python objects of a slice of a batch at a time, whatever the batch's size."""

from __future__ import annotations

import ctypes
import gc
import sys
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Bytes of text of a slice, at most, unless one text alone has more; rows of one, at most.
SLICE_BYTES, SLICE_ROWS = 1 << 20, 1024
_LIBC = ctypes.CDLL(None) if sys.platform == "linux" and hasattr(ctypes.CDLL(None), "malloc_trim") else None


def release() -> None:
    """Give freed memory back to the system: Python workers live on, with the next batch's needs on top of the last one's."""
    gc.collect(0)
    pa.default_memory_pool().release_unused()
    if _LIBC is not None:
        _LIBC.malloc_trim(0)


def slices(sizes: np.ndarray, most_bytes: int = SLICE_BYTES, most_rows: int = SLICE_ROWS) -> Iterator[tuple[int, int]]:
    """Consecutive row ranges of most_bytes and most_rows at most; a row above the former stands alone."""
    ends, start = np.cumsum(sizes), 0
    while start < len(ends):
        before = int(ends[start - 1]) if start else 0
        stop = max(start + 1, min(start + most_rows, int(np.searchsorted(ends, before + most_bytes, "right"))))
        yield start, stop
        start = stop


def text_sizes(texts: pa.Array) -> np.ndarray:
    """Bytes of each text; none of a null."""
    return pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)


def by_slices(function: Callable, kind: T.DataType, arrow_kind: pa.DataType) -> Callable:
    """An Arrow UDF of a function of a text (or None), which is applied slice by slice."""

    @F.arrow_udf(kind)
    def run(texts: pa.Array) -> pa.Array:
        out = [pa.array(map(function, texts.slice(a, b - a).to_pylist()), arrow_kind) for a, b in slices(text_sizes(texts))]
        done = pa.concat_arrays(out) if out else pa.array([], arrow_kind)
        release()
        return done

    return run
