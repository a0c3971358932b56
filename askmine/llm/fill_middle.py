"""Fill-in-the-middle: texts cut at two token bounds and put together anew, so that a model learns to fill the middle.

Whole batches are cut at once on their Arrow buffers. A table of byte classes tells whitespace; a token starts where a text
starts, or where whitespace follows another byte, which a mask over neighbouring bytes marks. The running sum of the mask,
less its value before the text, numbers a text's tokens; one binary search in it gives all cuts of the batch. The pieces of
all texts lie end to end in the buffer that came in; one ``take`` puts them and the marks between them in their new order.

The two cuts and the form depend on the key alone. A null or empty text, or one that holds a mark, stays plain. A null key
counts as an empty one. Texts of any length are taken whole; repeated rows are treated alike. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from askmine.llm.base import quoted, release, row_blocks, row_of, text_buffer, with_fields

PREFIX, SUFFIX, MIDDLE = MARKS = ("<P>", "<S>", "<M>")
IS_SPACE = np.zeros(256, bool)
IS_SPACE[[0x20, *range(0x09, 0x0E)]] = True
BLOCK_BYTES = 4 << 20
PLAIN, PSM, SPM = FORMS = ("plain", "psm", "spm")
#: Per form, what stands in the output one after the other: pieces 0 to 2 (prefix, middle, suffix), marks 3 to 5 (as MARKS), 6 for nothing.
LAYOUT = np.array([[0, 1, 2, 6, 6, 6], [3, 0, 4, 2, 5, 1], [4, 2, 3, 0, 5, 1]])
#: The same for reading back: the places of prefix, middle and suffix among the parts between marks.
PARTS = {PSM: (1, 3, 2), SPM: (2, 3, 1)}
OUT = "n bigint, form string, prefix_chars bigint, middle_chars bigint, output string"


def draws(key: Column, seed: int = 42, n: int = 4) -> list[Column]:
    """n unsigned 32-bit numbers from the seed and the key."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 1 + 8 * i, 8), 16, 10).cast("bigint") for i in range(n)]


def marked(data: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Which texts hold a mark; ends: where each text starts, and where the last one ends."""
    third = [ord(m[1]) for m in MARKS]
    at = np.flatnonzero((data[:-2] == ord("<")) & (data[2:] == ord(">")) & np.isin(data[1:-1], third)) if len(data) > 2 else np.zeros(0, np.int64)
    text = np.searchsorted(ends, at, "right") - 1
    out = np.zeros(len(ends) - 1, bool)
    out[text[at + 3 <= ends[text + 1]]] = True
    return out


def numbered(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(the running number of the token that each byte lies in, from 1 over the whole batch; that before each text, and after the last)."""
    space = IS_SPACE[data]
    starts = np.zeros(len(data), bool)
    starts[1:] = space[1:] & ~space[:-1]
    starts[ends[:-1][np.diff(ends) > 0]] = True
    running = np.cumsum(starts, dtype=np.int64 if len(data) >> 31 else np.int32)
    return running, np.concatenate([[0], running])[ends].astype(np.int64)


def _characters(data: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Code points of the spans from a to b."""
    before = np.zeros(len(data) + 1, np.int64 if len(data) >> 31 else np.int32)
    np.cumsum((data & 0xC0) != 0x80, out=before[1:])
    return before[b] - before[a]


def cut(text: pa.Array, h: list[np.ndarray], fim_percent: int, spm_percent: int) -> list[pa.Array]:
    """n, form, prefix_chars, middle_chars and output of a batch of texts; h: four draws for each."""
    raw, ends = text_buffer(text)
    data, ends = raw[ends[0] : ends[-1]], ends - ends[0]
    running, base = numbered(data, ends)
    n = np.diff(base)
    bounds = [np.minimum(h[0] % (n + 1), h[1] % (n + 1)), np.maximum(h[0] % (n + 1), h[1] % (n + 1))]
    # the byte at which token u starts (from 0) is the first with the number base + u + 1; after the last token the text ends
    first, second = (np.where(u < n, np.searchsorted(running, (base[:-1] + u + 1).astype(running.dtype)), ends[1:]) for u in bounds)
    plain = (n == 0) | marked(data, ends) | (h[2] % 100 >= fim_percent)
    form = np.where(plain, 0, np.where(h[3] % 100 < spm_percent, 2, 1))

    where = np.empty(3 * len(n) + 1, np.int64)
    where[0::3], where[1::3], where[2::3] = ends, first, second
    tail = np.cumsum([len(m) for m in MARKS] + [0]) + len(data)
    pool = pa.LargeStringArray.from_buffers(3 * len(n) + 4, pa.py_buffer(np.concatenate([where, tail])), pa.py_buffer(data.tobytes() + "".join(MARKS).encode()))
    wanted = LAYOUT[form]
    order = np.where(wanted < 3, wanted + 3 * np.arange(len(n))[:, None], wanted - 3 + 3 * len(n))
    laid = pool.take(pa.array(order.ravel()))
    offsets = np.frombuffer(laid.buffers()[1], np.int64)[laid.offset : laid.offset + len(laid) + 1][::6]
    output = pa.LargeStringArray.from_buffers(len(n), pa.py_buffer(offsets.copy()), laid.buffers()[2] or pa.py_buffer(b""))
    spans = [pa.array(_characters(data, a, b), pa.int64(), mask=plain) for a, b in ((ends[:-1], first), (first, second))]
    return [pa.array(n, pa.int64()), pa.array(np.array(FORMS)[form], pa.string()), *spans, output.cast(pa.string())]


def transform(docs: DataFrame, key: str = "doc_id", text: str = "text", seed: int = 42, fim_percent: int = 50, spm_percent: int = 80, carry: bool = False) -> DataFrame:
    """key, n (tokens), form, prefix_chars, middle_chars (null where plain) and output; with carry also ``row``, the other columns."""
    h = [d.alias(f"h{i}") for i, d in enumerate(draws(F.col(quoted(key)), seed))]
    slim = docs.select(F.col(quoted(key)).alias("key"), *([row_of(docs)] if carry else []), F.col(quoted(text)).cast("string").alias("text"), *h)
    held = slim.schema[: 2 if carry else 1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = len(held)
            for a, b in row_blocks(np.diff(text_buffer(batch.column(at))[1]).tolist(), BLOCK_BYTES):
                part = batch.slice(a, b - a)
                made = cut(part.column(at), [c.to_numpy() for c in part.columns[at + 1 :]], fim_percent, spm_percent)
                yield pa.RecordBatch.from_arrays([*part.columns[:at], *made], [*(f.name for f in held), *(x.split()[0] for x in OUT.split(", "))])
            release()

    return slim.mapInArrow(run, with_fields(held, OUT)).withColumnRenamed("key", key)


def restored(form: str = "form", output: str = "output") -> Column:
    """The text that an output was made from."""
    parts = F.split(F.col(output), "|".join(MARKS))
    put = lambda places: F.concat(*[F.get(parts, F.lit(i)) for i in places])
    return F.when(F.col(form) == PSM, put(PARTS[PSM])).when(F.col(form) == SPM, put(PARTS[SPM])).otherwise(F.col(output))
