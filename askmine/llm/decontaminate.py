"""Benchmark decontamination with an FM-index per training shard.

A shard is a run of documents of about ``shard_bytes``. Its words become numbers: a word that the benchmark knows keeps
its number there, any other is a gap. What lies between gaps and is shorter than the shortest window can't hold an
occurrence and is left out of the index. The rest is indexed: suffix array, Burrows-Wheeler transform, a wavelet tree
(one bit row per level with its ranks) and sampled suffix positions. All windows are searched backwards at once, their
occurrences located by walking to the next sampled position, and the occurrences' spans merged.

Words are runs of bytes of 0-9, a-z and everything above 0x7F, once A-Z are lower-cased. Null texts and items have no
words; an item without words is never found; an item of fewer words than a window is one window. Repeated items are
each reported. Repeated rows each get their own result. Empty tables give no rows, or rows without hits. Texts are read
whole. Other columns may have any names. The benchmark is the query set: it goes to every task in blocks of about
BLOCK_BYTES, as word numbers (12 bytes a word at most), of which a worker opens one at a time.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from askmine.llm.base import blocks_for, quoted, release, row_blocks, row_of, text_buffer, total_bytes, with_fields
from askmine.llm.blocks import mixed
from askmine.llm.substring_dedup import WORD_BASE, word_bounds, word_hashes

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
IS_GAP = np.ones(256, bool)
IS_GAP[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = False
#: Bytes of benchmark text in a block, and every how many suffix positions one is sampled.
BLOCK_BYTES, SAMPLE = 8 << 20, 8
#: Bytes of benchmark text that go to every task at most, and shards that are searched with a block before the next is opened.
MOST_BYTES, SHARDS_AT_ONCE = 512 << 20, 16


def words_of(raw: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hashes, starts and ends (bytes, with one more byte after each text) and text number of the words of all texts."""
    lengths = np.diff(ends)
    data = np.zeros(int(lengths.sum()) + len(lengths), np.uint8)
    to = np.arange(int(lengths.sum()), dtype=np.int64) + np.repeat(np.arange(len(lengths)), lengths)
    data[to] = LOWER[raw[ends[0] : ends[-1]]]
    start, end = word_bounds(data, IS_GAP) if len(data) else (np.zeros(0, np.int64),) * 2
    text_end = np.cumsum(lengths + 1)
    return (word_hashes(data, start, end) if len(start) else np.zeros(0, np.uint64)), start, end, np.searchsorted(text_end, start, "right")


class Queries:
    """A block of benchmark items as it is sent out: their words as numbers, 12 bytes a word at most."""

    def __init__(self, items: list[str], texts: list[str | None], window: int):
        column = pa.array([t or "" for t in texts], pa.string())
        hashes, _, _, text = words_of(*text_buffer(column)) if texts else (np.zeros(0, np.uint64),) * 4
        self.vocabulary, numbers = np.unique(hashes, return_inverse=True)
        self.names, self.window = items, window
        self.words = (numbers + 1).astype(np.int32)
        self.edges = np.searchsorted(text, np.arange(len(items) + 1))

    def opened(self) -> Windows:
        return Windows(self)


class Windows:
    """A block's distinct windows, made where they are searched for: word numbers, lengths, and which items have each.

    Windows are told apart by 64 bits of hash.
    """

    def __init__(self, block: Queries):
        self.vocabulary, self.names, width = block.vocabulary, block.names, block.window
        size = np.diff(block.edges)
        many = np.where(size > 0, np.maximum(1, size - width + 1), 0)
        item = np.repeat(np.arange(len(size)), many)
        start = np.arange(len(item)) - np.repeat(np.cumsum(many) - many, many) + block.edges[:-1][item]
        length = np.minimum(width, size[item])
        padded = np.concatenate([block.words, np.zeros(width, np.int32)])
        hashes = np.zeros(len(item), np.uint64)
        for k in range(width):
            hashes = hashes * WORD_BASE + np.where(k < length, padded[start + k], 0).astype(np.uint64)
        hashes = mixed(hashes ^ length.astype(np.uint64) << np.uint64(56))
        order = np.lexsort((item, hashes))
        new = np.ones(len(order), bool)
        new[1:] = hashes[order][1:] != hashes[order][:-1]
        one = order[new]
        self.n, self.lengths, start = len(one), length[one], start[one]
        once = new.copy()  # an item's window that it repeats counts once
        once[1:] |= item[order][1:] != item[order][:-1]
        self.item = item[order][once]
        self.item_edges = np.append(np.flatnonzero(new[once]), once.sum())
        self.shortest = int(self.lengths.min()) if self.n else 0
        # from the last word backwards; 0 beyond the first
        self.by_place = np.stack([np.where(k < self.lengths, padded[np.maximum(start + self.lengths - 1 - k, 0)], 0) for k in range(width)]) if self.n else np.zeros((width, 0), np.int32)
        self.maybe = np.zeros(1 << 20, bool)
        self.maybe[(self.vocabulary >> np.uint64(44)).astype(np.int64)] = True

    def numbers(self, hashes: np.ndarray) -> np.ndarray:
        """The benchmark's number of each word, 0 for a word that it doesn't know."""
        out = np.zeros(len(hashes), np.int64)
        at = np.flatnonzero(self.maybe[(hashes >> np.uint64(44)).astype(np.int64)])
        place = np.searchsorted(self.vocabulary, hashes[at])
        place[place == len(self.vocabulary)] = 0
        hit = self.vocabulary[place] == hashes[at] if len(self.vocabulary) else np.zeros(0, bool)
        out[at[hit]] = place[hit] + 1
        return out

    def items(self, window: int) -> list[str]:
        return [self.names[i] for i in self.item[self.item_edges[window] : self.item_edges[window + 1]]]


class FMIndex:
    """Of a sequence of numbers in which 0 separates stretches; matches never cross a 0. It must end with a 0."""

    def __init__(self, text: np.ndarray, n_symbols: int):
        n = self.n = len(text)
        self.positions = _suffix_array(text)
        self.bwt = text[self.positions - 1]
        self.below = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=n_symbols))])
        self.levels = max(1, int(n_symbols - 1).bit_length())
        self.ones, self.zeros = [], []
        row = self.bwt
        for level in range(self.levels):
            bit = row >> (self.levels - 1 - level) & 1
            self.ones.append(np.concatenate([[0], np.cumsum(bit)]))
            self.zeros.append(n - int(bit.sum()))
            row = np.concatenate([row[bit == 0], row[bit == 1]])
        self.start = self._down(np.arange(n_symbols), np.zeros(n_symbols, np.int64))
        is_sample = (self.positions % SAMPLE == 0) | (self.bwt == 0)  # a walk never passes a separator
        self.is_sample, self.sample_rank, self.samples = is_sample, np.cumsum(is_sample) - 1, self.positions[is_sample]
        del self.positions

    def _down(self, symbols: np.ndarray, at: np.ndarray) -> np.ndarray:
        for level in range(self.levels):
            one = self.ones[level][at]
            at = np.where(symbols >> (self.levels - 1 - level) & 1, self.zeros[level] + one, at - one)
        return at

    def rank(self, symbols: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often each symbol stands before place at of the transform."""
        return self._down(symbols, at) - self.start[symbols]

    def search(self, by_place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The suffix ranges of all queries; by_place: rows of symbols from the last backwards, 0 where a query is over."""
        low, high = np.zeros(by_place.shape[1], np.int64), np.full(by_place.shape[1], self.n, np.int64)
        for row in by_place:
            at = np.flatnonzero((row > 0) & (low < high))
            if not len(at):
                break
            symbols = row[at]
            low[at] = self.below[symbols] + self.rank(symbols, low[at])
            high[at] = self.below[symbols] + self.rank(symbols, high[at])
        return low, high

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text positions of suffix ranks."""
        out, at, rows, steps = np.zeros(len(rows), np.int64), np.arange(len(rows)), rows.copy(), 0
        while len(at):
            done = self.is_sample[rows]
            out[at[done]] = self.samples[self.sample_rank[rows[done]]] + steps
            at, rows = at[~done], rows[~done]
            symbols = self.bwt[rows]
            rows = self.below[symbols] + self.rank(symbols, rows)
            steps += 1
        return out


def _suffix_array(text: np.ndarray) -> np.ndarray:
    """By prefix doubling; each 0 counts as a symbol of its own, so that comparisons end there."""
    n = len(text)
    gaps = text == 0
    symbols = np.where(gaps, np.cumsum(gaps) - 1, text + gaps.sum())
    rank = np.unique(symbols, return_inverse=True)[1].astype(np.int64)
    reach = 1
    while True:
        after = np.zeros(n, np.int64)
        after[: max(0, n - reach)] = rank[reach:] + 1
        pair = rank * (n + 1) + after
        order = np.argsort(pair, kind="stable")
        new = np.zeros(n, np.int64)
        new[1:] = pair[order][1:] != pair[order][:-1]
        rank[order] = np.cumsum(new)
        if n == 0 or rank[order[-1]] == n - 1:
            return order
        reach *= 2


def occurrences(hashes: np.ndarray, text: np.ndarray, queries: Windows) -> tuple[np.ndarray, np.ndarray]:
    """(query, first word) of every occurrence of the queries within a text."""
    none = np.zeros(0, np.int64), np.zeros(0, np.int64)
    if not queries.n or not len(hashes):
        return none
    numbers = queries.numbers(hashes)
    known = numbers > 0
    edge = np.ones(len(known), bool)
    edge[1:] = (known[1:] != known[:-1]) | (text[1:] != text[:-1])
    first = np.flatnonzero(edge)
    size = np.diff(np.append(first, len(known)))
    keep = known[first] & (size >= queries.shortest)
    first, size = first[keep], size[keep]
    if not len(first):
        return none
    place = np.arange(int((size + 1).sum())) - np.repeat(np.cumsum(size + 1) - size - 1, size + 1)
    word = np.repeat(first, size + 1) + place
    indexed = np.where(place < np.repeat(size, size + 1), numbers[np.minimum(word, len(numbers) - 1)], 0)
    index = FMIndex(indexed, len(queries.vocabulary) + 1)
    low, high = index.search(queries.by_place)
    count = np.maximum(0, high - low)
    query = np.repeat(np.arange(len(count)), count)
    rows = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) + np.repeat(low, count)
    return query, word[index.locate(rows)]


def shared_queries(benchmark: DataFrame, item: str, text: str, window: int, block_bytes: int = BLOCK_BYTES) -> list:
    """Broadcasts of Queries, each of about block_bytes of text; the driver holds one block at a time.

    The benchmark is the query set and goes to every task; one of over MOST_BYTES is refused.
    """
    size = total_bytes(benchmark, text)[1]
    if size > MOST_BYTES:
        raise ValueError(f"a benchmark of {size} bytes: search it in parts of {MOST_BYTES} at most")
    n = blocks_for(size, block_bytes)
    slim = benchmark.select(F.col(quoted(item)).cast("string").alias("item"), F.col(quoted(text)).cast("string").alias("text"))
    out = []
    for block in range(n):
        rows = slim.filter(F.pmod(F.xxhash64("item", "text"), F.lit(n)) == block).sort("item", "text").toArrow()
        queries = Queries([x or "" for x in rows["item"].to_pylist()], rows["text"].to_pylist(), window)
        del rows
        out.append(benchmark.sparkSession.sparkContext.broadcast(queries))
        del queries
        release()
    return out


def find(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id", item_text: str = "text", window: int = 10, shard_bytes: int = 2 << 20, carry: bool = False, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """key, n_words, n_hit, items (found, sorted as strings), spans (byte starts and ends to remove, in turn), cleaned (the text without them; null for null).

    carry: a struct ``row`` of the document's other columns comes along.
    """
    shared = shared_queries(benchmark, item, item_text, window, block_bytes)
    row = [row_of(docs, text)] if carry else []
    slim = docs.select(F.col(quoted(key)).alias("key"), F.col(quoted(text)).cast("string").alias("text"), *row)
    names = ["n_words", "n_hit", "items", "spans", "cleaned"]
    schema = with_fields([f for f in slim.schema if f.name != "text"], "n_words bigint, n_hit bigint, items array<string>, spans array<bigint>, cleaned string")

    def shard(part: pa.RecordBatch, read: tuple, step: np.ndarray, found: dict[int, set[str]]) -> list[pa.Array]:
        raw, ends = text_buffer(part.column(1))
        n = part.num_rows
        _, start, end, doc = read
        hit = np.cumsum(step[:-1]) > 0
        opens, closes = hit.copy(), hit.copy()
        same = doc[1:] == doc[:-1]
        opens[1:] &= ~(hit[:-1] & same)
        closes[:-1] &= ~(hit[1:] & same)
        a, b = np.flatnonzero(opens), np.flatnonzero(closes)
        lines = np.concatenate([[0], np.cumsum(np.diff(ends) + 1)])
        pairs = np.stack([start[a] - lines[doc[a]], end[b] - lines[doc[b]]], 1).ravel() if len(a) else np.zeros(0, np.int64)
        cuts = 2 * np.searchsorted(doc[a], np.arange(n + 1))
        texts = []
        for i in range(n):
            t = raw[ends[i] : ends[i + 1]].tobytes()
            if cuts[i] < cuts[i + 1]:
                gaps = [0, *pairs[cuts[i] : cuts[i + 1]].tolist(), len(t)]
                t = b"".join(t[x:y] for x, y in zip(gaps[::2], gaps[1::2]))
            texts.append(t if part.column(1)[i].is_valid else None)
        return [
            pa.array(np.bincount(doc, minlength=n), pa.int64()),
            pa.array(np.bincount(doc[hit], minlength=n), pa.int64()),
            pa.array([sorted(found.get(i, ())) for i in range(n)], pa.list_(pa.string())),
            pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.array(pairs, pa.int64())),
            pa.array(texts, pa.binary()).cast(pa.string()),
        ]

    def searched(parts: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The shards of a batch, by one block of the benchmark after another: one is open at a time."""
        reads = [words_of(*text_buffer(part.column(1))) for part in parts]
        steps = [np.zeros(len(hashes) + 1, np.int64) for hashes, *_ in reads]
        found: list[dict[int, set[str]]] = [defaultdict(set) for _ in parts]
        for number in range(len(shared)):
            queries = block_of_queries(number)
            for (hashes, _, _, doc), step, own in zip(reads, steps, found):
                query, at = occurrences(hashes, doc, queries)
                np.add.at(step, at, 1)
                np.subtract.at(step, at + queries.lengths[query], 1)
                for d, q in {*zip(doc[at].tolist(), query.tolist())}:
                    own[d].update(queries.items(q))
        for part, *known in zip(parts, reads, steps, found):
            own_columns = [part.column(i) for i in range(part.num_columns) if i != 1]
            yield pa.RecordBatch.from_arrays([*own_columns, *shard(part, *known)], ["key", *(["row"] if carry else []), *names])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = [batch.slice(a, b - a) for a, b in row_blocks(np.diff(text_buffer(batch.column(1))[1]).tolist(), shard_bytes)]
            for a in range(0, len(parts), SHARDS_AT_ONCE if len(shared) > 1 else 1):
                yield from searched(parts[a : a + (SHARDS_AT_ONCE if len(shared) > 1 else 1)])
            release()
        is_open.clear()

    is_open: dict[int, Windows] = {}

    def block_of_queries(number: int) -> Windows:
        if number not in is_open:
            is_open.clear()
            is_open[number] = shared[number].value.opened()
        return is_open[number]

    return slim.mapInArrow(run, schema).withColumnRenamed("key", key)
