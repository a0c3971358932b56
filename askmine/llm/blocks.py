"""Blocks of documents: text shuffled once by a hash of key and text, and packets of hashes sent between blocks and buckets.

A block is rebuilt in the same order whenever its rows are read (sorted by key, then text), so that answers can be
sent back as arrays in the order in which a block has asked, without row identities.

A block sends one packet to each of FAN buckets, whatever the number of blocks, so that packets stay of a size and their
number grows with the input. A bucket takes MOST_PACKETS packets at most. Where there are more blocks, the packets of
MOST_PACKETS blocks for a bucket are merged and sent on to FAN finer buckets, whose answers come back the same way: a
level more for every factor of MOST_PACKETS (with blocks of 4 MB one level serves 4 GB, two 4 TB, three 4 PB).
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from askmine.llm.base import blocks_for, quoted, release, row_of, text_buffer, total_bytes

#: Stands for a null key: before any other.
NULL_KEY = np.iinfo(np.int64).min
MIX_A, MIX_B = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def blocked(docs: DataFrame, key: str, text: str, block_bytes: int, carry: bool = False) -> tuple[DataFrame, int]:
    """(block, key, text) and the number of blocks, of about block_bytes each. The key must be an integer.

    carry: the other columns come along as a struct ``row``.
    """
    n_blocks = blocks_for(total_bytes(docs, text)[1], block_bytes)
    row = [row_of(docs, text)] if carry else []
    k, t = F.col(quoted(key)), F.col(quoted(text)).cast("string")
    block = F.pmod(F.xxhash64(k, t), F.lit(n_blocks)).cast("int")  # by the text too: rows of one key, or of none, are spread
    return docs.select(block.alias("block"), k.cast("bigint").alias("key"), t.alias("text"), *row), n_blocks


class Block:
    """A block's rows in their fixed order: keys, and the texts as one buffer with a byte after each text."""

    def __init__(self, rows: pa.Table, separator: bytes):
        rows = rows.drop_columns("block").combine_chunks()
        order = pc.sort_indices(rows, sort_keys=[("key", "ascending"), ("text", "ascending")], null_placement="at_start")
        rows = rows.take(order)
        self.row = rows["row"] if "row" in rows.column_names else None
        self.null_text = np.asarray(rows["text"].is_null().to_numpy(), bool)
        self.null_key = np.asarray(rows["key"].is_null().to_numpy(), bool)
        self.keys = rows["key"].fill_null(int(NULL_KEY)).to_numpy()
        raw, ends = text_buffer(rows["text"])
        lengths = np.diff(ends)
        parts = raw[ends[0] : ends[-1]] if len(ends) > 1 else raw[:0]
        self.n = len(lengths)
        self.ends = np.cumsum(lengths + len(separator)) - len(separator)
        self.starts = self.ends - lengths
        if separator:
            self.bytes = np.full(len(parts) + self.n, separator[0], np.uint8)
            to = np.arange(len(parts), dtype=np.int64)
            to += np.repeat(np.arange(self.n), lengths)
            self.bytes[to] = parts
        else:
            self.bytes = parts
        self.lengths = lengths

    def key_array(self, rows: np.ndarray | None = None) -> pa.Array:
        keys, null = (self.keys, self.null_key) if rows is None else (self.keys[rows], self.null_key[rows])
        return pa.array(keys, pa.int64(), mask=null)


def mixed(h: np.ndarray) -> np.ndarray:
    """Finish 64-bit hashes so that all bits depend on all."""
    h = (h ^ (h >> np.uint64(30))) * MIX_A
    h = (h ^ (h >> np.uint64(27))) * MIX_B
    return h ^ (h >> np.uint64(31))


#: Log of the buckets of a level, and most packets of a bucket.
FAN_BITS, MOST_PACKETS = 8, 1024


def parts_of(hashes: np.ndarray, level: int, fan_bits: int) -> list[tuple[int, int, int]]:
    """(bucket, start, end) of the buckets that sorted hashes have at a level, where a bucket's number has level * fan_bits bits."""
    bucket = (hashes >> np.uint64(64 - level * fan_bits)).astype(np.int64)
    edges = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]])) if len(bucket) else np.zeros(0, np.int64)
    return list(zip(bucket[edges].tolist(), edges.tolist(), [*edges[1:].tolist(), len(bucket)]))


def packets(block: int, columns: list[np.ndarray], level: int = 1, fan_bits: int = FAN_BITS) -> pa.Table:
    """A block's packets: bucket, block, and the columns, of which the first has sorted hashes."""
    parts = parts_of(columns[0], level, fan_bits)
    made = {f"c{i}": binaries([pack(c[a:b], i == 0) for _, a, b in parts]) for i, c in enumerate(columns)}
    return pa.table({"bucket": pa.array([x for x, _, _ in parts], pa.int32()), "block": pa.array([block] * len(parts), pa.int32()), **made})


class Merge:
    """What is said of the packets' entries. __call__ takes the entries' columns and gives (first, of, bits): the entries that
    stand for all equal ones, sorted by hash, each entry's number among them, and a row of bits for each kind of answer.
    combined takes an entry's bits and those of what stands for it a level above."""

    kinds: int

    def __call__(self, *columns: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        raise NotImplementedError

    def combined(self, own: np.ndarray, above: np.ndarray) -> np.ndarray:
        return own | above


def answered(asked: DataFrame, n_columns: int, merge: Merge, n_blocks: int, fan_bits: int = FAN_BITS, most_packets: int = MOST_PACKETS, level: int = 1) -> DataFrame:
    """block, bucket, bits: the answers to packets, the bits of a packet's entries in their order, kind by kind."""

    def opened(rows: pa.Table) -> tuple[pa.Table, list[np.ndarray], np.ndarray]:
        rows = rows.take(pc.sort_indices(rows, sort_keys=[("block", "ascending")]))
        lists = [[unpack(x, i == 0) for x in rows[f"c{i}"].to_pylist()] for i in range(n_columns)]
        return rows, [np.concatenate(x) for x in lists], np.cumsum([len(x) for x in lists[0]])[:-1]

    def told(rows: pa.Table, bits: np.ndarray, cuts: np.ndarray) -> pa.Table:
        parts = np.split(bits, cuts, axis=1)
        return pa.table({"block": rows["block"], "bucket": rows["bucket"], "bits": binaries([np.packbits(x.ravel()).tobytes() for x in parts])})

    if n_blocks <= most_packets:

        def answer(key: tuple, rows: pa.Table) -> pa.Table:
            rows, columns, cuts = opened(rows)
            return told(rows, merge(*columns)[2], cuts)

        return asked.groupBy("bucket").applyInArrow(released(answer), "block int, bucket int, bits binary")

    def send_on(key: tuple, rows: pa.Table) -> pa.Table:
        _, columns, _ = opened(rows)
        first, _, _ = merge(*columns)
        return packets(key[1].as_py(), [c[first] for c in columns], level + 1, fan_bits)

    def send_back(key: tuple, rows: pa.Table, answers: pa.Table) -> pa.Table:
        rows, columns, cuts = opened(rows)
        first, of, own = merge(*columns)
        above = bits_of(answers, parts_of(columns[0][first], level + 1, fan_bits), merge.kinds)
        return told(rows, merge.combined(own, above[:, of]), cuts)

    marked = asked.withColumn("above", F.floor(F.col("block") / F.lit(most_packets)).cast("int"))
    sent = marked.groupBy("bucket", "above").applyInArrow(released(send_on), asked.schema)
    known = answered(sent, n_columns, merge, -(-n_blocks // most_packets), fan_bits, most_packets, level + 1)
    known = known.withColumn("above", F.col("block")).withColumn("coarse", F.shiftright("bucket", fan_bits))
    return marked.groupBy("bucket", "above").cogroup(known.groupBy("coarse", "above")).applyInArrow(released(send_back), "block int, bucket int, bits binary")


def bits_of(answers: pa.Table, parts: list[tuple[int, int, int]], kinds: int) -> np.ndarray:
    """The bits of all of a block's entries, a row for each kind; parts as it has sent them."""
    found = [np.unpackbits(np.frombuffer(x, np.uint8), count=kinds * (b - a)).astype(bool).reshape(kinds, -1) for x, (_, a, b) in zip(by_bucket(answers, "bits"), parts)]
    return np.concatenate([np.zeros((kinds, 0), bool), *found], axis=1)


def pack(values: np.ndarray, sorted_: bool = False) -> bytes:
    """64-bit values by byte planes, of the steps if they are sorted, so that the shuffle's codec drops empty planes."""
    values = values.astype(np.uint64, copy=False) if values.dtype != np.int64 else values.view(np.uint64)
    if sorted_ and len(values):
        values = np.diff(values, prepend=np.uint64(0))
    return np.ascontiguousarray(values.view(np.uint8).reshape(-1, 8).T).tobytes()


def unpack(data: bytes, sorted_: bool = False) -> np.ndarray:
    values = np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(8, -1).T).view(np.uint64).ravel()
    return np.cumsum(values, dtype=np.uint64) if sorted_ else values


def released(run: Callable) -> Callable:
    """run, with the memory of each group given back after it; the number of arguments tells Spark what they are."""
    if run.__code__.co_argcount == 3:
        def over_two(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
            out = run(key, left, right)
            release()
            return out

        return over_two

    def over_one(key: tuple, rows: pa.Table) -> pa.Table:
        out = run(key, rows)
        release()
        return out

    return over_one


def binaries(values: list[bytes]) -> pa.Array:
    return pa.array(values, pa.binary())


def by_bucket(rows: pa.Table, column: str) -> list[bytes]:
    """The binaries of a block's answers in the order of the buckets."""
    order = pc.sort_indices(rows, sort_keys=[("bucket", "ascending")])
    return rows[column].take(order).to_pylist()
