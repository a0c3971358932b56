"""SimHash near-duplicates by segment popcounts.

A fingerprint maps to the bit counts of its 32 segments of two bits. One differing bit moves one count by one, so the
Manhattan distance of two count vectors is a lower bound of the Hamming distance. Pairs at Hamming distance 4 or less
have count vectors that differ in 4 segments at most. With the segments dealt into g groups, g - 4 groups at least
have Manhattan distance 0: the pair shares a grid cell in the projection on some g - 4 groups. The range join is thus
an equi join on (projection, cell), and each candidate is then verified on all 64 bits.

Within a cell, verified links become a star (a spanning forest), never all pairs; equal fingerprints are one node.
A cell above HOT_CELL fingerprints is divided once more, by the same bound on its other segments: in five parts of them,
one at least must agree. All of it is exact; nothing is capped.

Rows: null and empty texts have no words, hence fingerprint zero, and link like any other. Fewer words than a shingle:
the whole sequence is the one shingle. Rows that repeat a doc_id keep a row each. A null doc_id never names a component
unless the component has no other. An empty table gives no rows; columns other than the key and text aren't read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from askmine.llm.base import checkpointed, joined_hot, quoted, release, text_buffer, with_fields
from askmine.llm.components import components

LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))
SEGMENT_BITS, SEGMENTS = 2, 32
EVEN_BITS = 0x5555555555555555
#: Fingerprints in a cell above which it is divided once more.
HOT_CELL = 4096


def fingerprint(text: bytes, words_each: int = 4) -> int:
    """64 bits; a bit is set if it is set in over half of the shingles' XXH64 (seed 42)."""
    words = text.translate(LOWER).split()
    if not words:
        return 0
    joined = b" ".join(words)
    n = max(1, len(words) - words_each + 1)
    lengths = np.fromiter(map(len, words), np.int64, len(words)) + 1
    ends = np.cumsum(lengths) - 1
    first = (ends - lengths + 1)[:n].tolist()
    last = ends[min(words_each, len(words)) - 1 :].tolist()
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(joined[a:b], 42) for a, b in zip(first, last)], "<u8")
    counts = np.zeros(64, np.int64)
    for start in range(0, n, 1 << 16):
        bits = np.unpackbits(hashes[start : start + (1 << 16)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text", words_each: int = 4) -> DataFrame:
    """key, fp (the fingerprint's bits as a signed long)."""
    slim = docs.select(F.col(quoted(key)).alias("key"), F.col(quoted(text)).cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, ends = text_buffer(batch.column(1))
            prints = np.array([fingerprint(raw[a:b].tobytes(), words_each) for a, b in zip(ends[:-1], ends[1:])], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(prints.view(np.int64), pa.int64())], ["key", "fp"])
            release()

    return slim.mapInArrow(run, with_fields([slim.schema["key"]], "fp bigint")).withColumnRenamed("key", key)


def _long(x: int) -> Column:
    return F.lit(x - (1 << 64) if x >= 1 << 63 else x).cast("bigint")


def segment_counts(fp: Column) -> Column:
    """The 32 counts (0 to 2) of the two-bit segments, two bits each."""
    low, high = fp.bitwiseAND(_long(EVEN_BITS)), F.shiftrightunsigned(fp, 1).bitwiseAND(_long(EVEN_BITS))
    return low.bitwiseXOR(high).bitwiseOR(F.shiftleft(low.bitwiseAND(high), 1))  # the sum; a long's + checks its sign


def _mask(segments: range | list[int]) -> int:
    return sum(3 << (SEGMENT_BITS * s) for s in segments)


def projections(n_groups: int, distance: int) -> list[int]:
    """A mask for each choice of n_groups - distance groups of segments."""
    groups = [[s for s in range(SEGMENTS) if s * n_groups // SEGMENTS == g] for g in range(n_groups)]
    return [_mask([s for g in chosen for s in groups[g]]) for chosen in combinations(range(n_groups), n_groups - distance)]


def _parts(mask: int, distance: int) -> list[int]:
    """The segments outside mask in distance + 1 parts: in one of them a linked pair has equal counts."""
    rest = [s for s in range(SEGMENTS) if not mask >> (SEGMENT_BITS * s) & 3]
    return [_mask(rest[i :: distance + 1]) for i in range(distance + 1)]


def groups_for(n: int) -> int:
    """How many groups keep cells small: more groups, more and finer projections. Any choice finds every link."""
    return 6 if n < 30_000_000 else 7 if n < 1_000_000_000 else 8


def cell_links(cells: np.ndarray, prints: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of the links within each run of equal cells: (index, root index)."""
    n = len(prints)
    root = np.arange(n)
    at, d = np.arange(n - 1), 1
    while len(at):
        at = at[at + d < n]
        at = at[cells[at] == cells[at + d]]
        a = at[np.bitwise_count(prints[at] ^ prints[at + d]) <= distance]
        b = a + d
        while len(a):
            x, y = root[a], root[b]
            open_ = x != y
            if not open_.any():
                break
            a, b, x, y = a[open_], b[open_], x[open_], y[open_]
            np.minimum.at(root, np.maximum(x, y), np.minimum(x, y))
            while not np.array_equal(up := root[root], root):
                root = up
        d += 1
    moved = np.flatnonzero(root != np.arange(n))
    return moved, root[moved]


def links(prints: DataFrame, distance: int = 4, n_groups: int | None = None, hot_cell: int = HOT_CELL) -> DataFrame:
    """a, b (fingerprints): edges whose components are those of all pairs at distance or less. prints: distinct fp."""
    masks = projections(n_groups or groups_for(prints.count()), distance)
    counts = segment_counts(F.col("fp"))
    keyed = prints.select("fp", counts.alias("v")).select("fp", "v", F.posexplode(F.array(*[F.col("v").bitwiseAND(_long(m)) for m in masks])).alias("p", "cell"))
    hot = keyed.groupBy("p", "cell").count().filter(F.col("count") > hot_cell).select("p", "cell", F.lit(True).alias("hot"))
    parts = F.array(*[F.array(*[_long(x) for x in _parts(m, distance)]) for m in masks])
    divided = F.when(F.col("hot"), F.transform(parts[F.col("p")], lambda m, i: F.struct((i + 1).alias("part"), F.col("v").bitwiseAND(m).alias("inner")))).otherwise(
        F.array(F.struct(F.lit(0).alias("part"), F.lit(0).cast("bigint").alias("inner")))
    )
    cells = keyed.join(hot, ["p", "cell"], "left").select("fp", "p", "cell", F.explode(divided).alias("d")).select("fp", F.xxhash64("p", "cell", "d.part", "d.inner").alias("cell"))
    # a 64-bit hash that two cells share only adds candidates, which are verified
    dealt = cells.repartition("cell").sortWithinPartitions("cell", "fp")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []

        def found(cells: np.ndarray, prints: np.ndarray) -> pa.RecordBatch:
            i, j = cell_links(cells, prints, distance)
            return pa.RecordBatch.from_arrays([pa.array(prints[i].view(np.int64)), pa.array(prints[j].view(np.int64))], ["a", "b"])

        for batch in batches:
            prints, cells = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
            prints = prints.view(np.uint64)
            if not len(cells):
                continue
            held.append((cells, prints))
            if cells[-1] == held[0][0][0]:
                continue  # one cell goes on
            cells, prints = (np.concatenate(x) for x in zip(*held))
            cut = np.searchsorted(cells, cells[-1])
            yield found(cells[:cut], prints[:cut])
            held = [(cells[cut:], prints[cut:])]
        if held:
            yield found(*(np.concatenate(x) for x in zip(*held)))

    return dealt.select("fp", "cell").mapInArrow(run, "a bigint, b bigint").distinct()


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", words_each: int = 4, distance: int = 4) -> DataFrame:
    """key, fp, component_id (the smallest key reachable by links, its own included) of every row."""
    prints = checkpointed(fingerprints(docs, key, text, words_each).toDF("key", "fp"))
    least = checkpointed(prints.groupBy("fp").agg(F.min("key").alias("least"), F.count(F.lit(1)).alias("n")))
    roots = components(links(least.select("fp"), distance))
    named = roots.join(least, roots["node"] == least["fp"])
    ids = named.groupBy("root").agg(F.min("least").alias("component_id"), F.count(F.lit(1)).alias("n"))
    of_node = joined_hot(roots, ids, "root", least.count(), "n").select(F.col("node").alias("fp"), "component_id")
    of_print = least.join(of_node, "fp", "left").select("fp", F.coalesce("component_id", "least").alias("component_id"), "n")
    return joined_hot(prints, checkpointed(of_print), "fp", prints.count(), "n").select(F.col("key").alias(key), "fp", "component_id")
