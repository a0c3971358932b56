"""Substring dedup over word windows: Rabin-Karp hashes of every window, counted in Spark.

Texts are dealt into blocks (one shuffle of the text, read twice). Each block hashes every window of its documents
with a rolling polynomial, keeps each distinct hash once with the smallest key that has it, and sends those, sorted and
packed, to hash buckets: a window of a passage that a third of all rows share costs a bucket one entry per block. Spark
groups the packets, and a group finds the smallest key of each hash over all blocks and answers with a bit per entry (see
``blocks``: the packets grow with the input, not with its square); blocks turn the bits into repeated windows, and merge
those into maximal removal intervals. A row of Spark's own for each window would take over four times the input's disk.

Words are runs of bytes other than space and 0x09 to 0x0D. A window is removed if its word sequence also starts in a
row with a smaller key. Rows with equal keys never remove each other; a null key counts as smaller than any other. Null
and empty texts have no words. A row of fewer words than a window keeps all. An empty table gives no rows. Only the key
and the text are read. Windows are told apart by 64 bits of hash.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from askmine.llm.blocks import FAN_BITS, MOST_PACKETS, Block, Merge, answered, bits_of, blocked, mixed, packets, parts_of, released

#: Odd bases of the two polynomials: over the bytes of a word, and over the words of a window.
BYTE_BASE, WORD_BASE = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD1342543DE82EF95)
IS_SPACE = np.zeros(256, bool)
IS_SPACE[[0x20, *range(0x09, 0x0E)]] = True
#: Bytes hashed at a time.
STRIDE = 1 << 20


def word_bounds(data: np.ndarray, is_gap: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of bytes that aren't gaps; the last byte must be a gap."""
    gap = is_gap[data]
    edges = np.flatnonzero(gap[1:] != gap[:-1]) + 1
    if len(gap) and not gap[0]:
        edges = np.concatenate([[0], edges])
    return edges[::2], edges[1::2]


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit polynomial hash of each word's bytes."""
    lengths = ends - starts
    out = np.empty(len(starts), np.uint64)
    a = 0
    total = np.cumsum(lengths)
    while a < len(starts):
        b = max(a + 1, int(np.searchsorted(total, (total[a - 1] if a else 0) + STRIDE, "right")))
        size = lengths[a:b]
        first = np.cumsum(size) - size
        place = np.arange(first[-1] + size[-1]) - np.repeat(first, size)
        powers = np.multiply.accumulate(np.full(int(size.max()) + 1, BYTE_BASE))
        terms = powers[place] * (data[place + np.repeat(starts[a:b], size)].astype(np.uint64) + np.uint64(1))
        out[a:b] = np.add.reduceat(terms, first)
        a = b
    return mixed(out)


def window_hashes(words: np.ndarray, width: int) -> np.ndarray:
    """The Rabin-Karp hash of each window of words."""
    n = len(words) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    h = words[:n].copy()
    for i in range(1, width):
        h *= WORD_BASE
        h += words[i : i + n]
    return mixed(h)


class Windows:
    """A block's words and windows, and its distinct window hashes with the smallest key of each."""

    def __init__(self, rows: pa.Table, width: int):
        self.block = block = Block(rows, b" ")
        self.width = width
        self.word_start, self.word_end = word_bounds(block.bytes, IS_SPACE)
        self.first = np.searchsorted(self.word_start, block.starts)
        self.last = np.searchsorted(self.word_start, block.ends)
        self.doc = np.repeat(np.arange(block.n), self.last - self.first)
        h = window_hashes(word_hashes(block.bytes, self.word_start, self.word_end) if len(self.word_start) else np.zeros(0, np.uint64), width)
        self.at = np.flatnonzero(self.doc[: len(h)] == self.doc[width - 1 :]) if len(h) else np.zeros(0, np.int64)
        h = h[self.at]
        order = np.argsort(h, kind="stable")  # stable: the smallest key comes first
        h = h[order]
        new = np.ones(len(h), bool)
        new[1:] = h[1:] != h[:-1]
        self.hashes = h[new]
        self.keys = block.keys[self.doc[self.at[order[new]]]]
        self.of = np.empty(len(h), np.int64)
        self.of[order] = np.cumsum(new) - 1

    def repeated(self, elsewhere: np.ndarray) -> np.ndarray:
        """Of each window, whether a smaller key has it: here, or by the buckets' answers."""
        own = self.block.keys[self.doc[self.at]]
        return elsewhere[self.of] | (own > self.keys[self.of])

    def removed_words(self, repeated: np.ndarray) -> np.ndarray:
        step = np.zeros(len(self.word_start) + 1, np.int32)
        at = self.at[repeated]
        step[at] += 1
        np.subtract.at(step, at + self.width, 1)
        return np.cumsum(step[:-1]) > 0


class Least(Merge):
    """Of equal hashes the one with the smallest key stands for all; the bit says that a smaller key has the hash."""

    kinds = 1

    def __call__(self, hashes: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        keys = keys.view(np.int64)
        order = np.lexsort((keys, hashes))
        new = np.ones(len(hashes), bool)
        new[1:] = hashes[order][1:] != hashes[order][:-1]
        of = np.empty(len(hashes), np.int64)
        of[order] = np.cumsum(new) - 1
        first = order[new]
        return first, of, (keys > keys[first][of])[None]


def _apply(width: int, fan_bits: int):
    def run(key: tuple, rows: pa.Table, answers: pa.Table) -> pa.Table:
        w = Windows(rows, width)
        block = w.block
        (elsewhere,) = bits_of(answers, parts_of(w.hashes, 1, fan_bits), 1)
        removed = w.removed_words(w.repeated(elsewhere))
        keep = ~removed
        step = np.zeros(len(block.bytes) + 1, np.int8)
        step[w.word_start[keep]] += 1
        step[w.word_end[keep] + 1] -= 1  # with the gap after each word, made one space
        data = block.bytes.copy()
        data[w.word_end] = 0x20
        taken = np.cumsum(step[:-1], dtype=np.int8).astype(bool)
        size = np.concatenate([[0], np.cumsum(taken)])
        data = data[taken]
        texts = [data[a : max(a, b - 1)].tobytes() for a, b in zip(size[block.starts], size[np.minimum(block.ends + 1, len(block.bytes))])]
        count = np.concatenate([[0], np.cumsum(removed)])
        opened = np.concatenate([[0], np.cumsum(removed & ~np.concatenate([[False], removed[:-1] & (w.doc[1:] == w.doc[:-1])])[: len(removed)])])
        return pa.table(
            {
                "key": block.key_array(),
                "n_words": pa.array(w.last - w.first, pa.int64()),
                "n_removed": pa.array(count[w.last] - count[w.first], pa.int64()),
                "n_intervals": pa.array(opened[w.last] - opened[w.first], pa.int64()),
                "kept": pa.array(texts, pa.binary()).cast(pa.string()),
            }
        )

    return released(run)


def remove_repeated_windows(docs: DataFrame, key: str = "doc_id", text: str = "text", width: int = 13, block_bytes: int = 4 << 20, fan_bits: int = FAN_BITS, most_packets: int = MOST_PACKETS) -> DataFrame:
    """key, n_words, n_removed, n_intervals (maximal removed runs of words), kept (the other words, joined by one space)."""
    blocks, n = blocked(docs, key, text, block_bytes)

    def ask(key: tuple, rows: pa.Table) -> pa.Table:
        w = Windows(rows, width)
        return packets(key[0].as_py(), [w.hashes, w.keys], 1, fan_bits)

    asked = blocks.groupBy("block").applyInArrow(released(ask), "bucket int, block int, c0 binary, c1 binary")
    answers = answered(asked, 2, Least(), n, fan_bits, most_packets)
    done = blocks.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(_apply(width, fan_bits), "key bigint, n_words bigint, n_removed bigint, n_intervals bigint, kept string")
    return done.withColumnRenamed("key", key)
