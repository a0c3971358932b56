"""Quality rules on repetition, from a suffix array of the words of each text.

The suffixes (by words) of all texts of a batch are sorted at once by prefix doubling; words of different texts are
different symbols, so that intervals of longest common prefixes stay within a text. The longest prefix that a suffix
shares with a neighbour in the array ends a maximal repeated substring; the spans of those of MIN_WORDS words or more
are united. A text fails if they cover too large a share of its words, or if the longest of them is too long.

Null, empty and blank texts have no words: all counts are 0 and the base rule fails them. Texts of any length are taken
whole. Repeated rows each get their own row. An empty table gives no rows. Only the key and the text are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from askmine.llm.base import row_blocks, text_buffer
from askmine.llm.blocks import mixed
from askmine.llm.substring_dedup import IS_SPACE, word_bounds, word_hashes

#: Repeats of fewer words don't count; the share of words that repeats may cover; words of the longest repeat that passes.
MIN_WORDS, MOST_COVERED, LONGEST = 8, 0.4, 50
IS_SYMBOL = np.zeros(256, bool)
IS_SYMBOL[list(b"#*$%&|<>")] = True
SHARD_BYTES = 4 << 20


def shared_prefixes(symbols: np.ndarray) -> np.ndarray:
    """For each suffix, the words of the longest prefix that another suffix shares (2 stands for 2 or fewer)."""
    n = len(symbols)
    out = np.full(n, 2, np.int64)
    if n < 2:
        return out
    order = np.argsort(symbols, kind="stable")
    new = np.ones(n, bool)
    new[1:] = symbols[order][1:] != symbols[order][:-1]
    rank = np.empty(n, np.int64)
    first = np.flatnonzero(new)
    rank[order] = np.repeat(first, np.diff(np.append(first, n)))
    levels, reach = [], 1
    at = order[_tied(new)]  # in the order of their ranks
    while len(at):
        levels.append((reach, rank.copy()))
        own, after = rank[at], np.where(at + reach < n, rank[np.minimum(at + reach, n - 1)] + 1, 0)
        inner = np.lexsort((after, own))
        at, own, after = at[inner], own[inner], after[inner]
        group = np.ones(len(at), bool)
        group[1:] = own[1:] != own[:-1]
        new = group.copy()
        new[1:] |= after[1:] != after[:-1]
        place = np.arange(len(at))
        rank[at] = own + np.maximum.accumulate(np.where(new, place, 0)) - np.maximum.accumulate(np.where(group, place, 0))
        at = at[_tied(new)]
        reach *= 2
    order[rank] = np.arange(n)
    if len(levels) < 2:
        return out
    two = levels[1][1]  # ranks by the first two words
    a, b = order[:-1], order[1:]
    pair = two[a] == two[b]
    a, b = a[pair], b[pair]
    common = np.zeros(len(a), np.int64)
    for reach, ranks in reversed(levels):
        inside = np.maximum(a, b) + common < n
        same = np.zeros(len(a), bool)
        same[inside] = ranks[a[inside] + common[inside]] == ranks[b[inside] + common[inside]]
        common[same] += reach
    np.maximum.at(out, a, common)
    np.maximum.at(out, b, common)
    return out


def _tied(new: np.ndarray) -> np.ndarray:
    """Places in groups of several; new marks the first of each group."""
    return ~(new & np.append(new[1:], True))


def covered(starts: np.ndarray, lengths: np.ndarray, n: int) -> np.ndarray:
    step = np.zeros(n + 1, np.int64)
    np.add.at(step, starts, 1)
    np.subtract.at(step, starts + lengths, 1)
    return np.cumsum(step[:-1]) > 0


def duplicate_lines(text: bytes) -> int:
    lines = [line for line in text.split(b"\n") if line.strip()]
    return len(lines) - len(set(lines))


def measure(docs: DataFrame, key: str = "doc_id", text: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """key, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_covered (words in repeats), longest (words)."""
    slim = docs.select(F.col(key), F.col(text).cast("string").alias("text"))
    kind = slim.schema[0].dataType.simpleString()
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_covered", "longest"]

    def shard(column: pa.Array) -> list[pa.Array]:
        raw, ends = text_buffer(column)
        lengths = np.diff(ends)
        n = len(lengths)
        own = raw[ends[0] : ends[-1]]
        data = np.full(len(own) + n, 0x20, np.uint8)
        data[np.arange(len(own), dtype=np.int64) + np.repeat(np.arange(n), lengths)] = own
        text_end = np.cumsum(lengths + 1)
        per_text = lambda flags: np.diff(np.concatenate([[0], np.cumsum(flags)])[np.concatenate([[0], text_end])])
        chars, symbols = per_text(((data & 0xC0) != 0x80) & ~IS_SPACE[data]), per_text(IS_SYMBOL[data])
        start, end = word_bounds(data, IS_SPACE)
        doc = np.searchsorted(text_end, start, "right")
        hashes = word_hashes(data, start, end) if len(start) else np.zeros(0, np.uint64)
        shared = shared_prefixes(mixed(hashes ^ mixed(doc.astype(np.uint64) + np.uint64(1))))
        three, long_ = np.flatnonzero(shared >= 3), np.flatnonzero(shared >= min_words)
        longest = np.zeros(n, np.int64)
        np.maximum.at(longest, doc[long_], shared[long_])
        count = lambda flags: np.bincount(doc[flags], minlength=n)
        lines = [duplicate_lines(raw[a:b].tobytes()) for a, b in zip(ends[:-1], ends[1:])]
        out = [np.bincount(doc, minlength=n), chars, symbols, lines, count(covered(three, np.full(len(three), 3), len(start))), count(covered(long_, shared[long_], len(start))), longest]
        return [pa.array(x, pa.int64()) for x in out]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in row_blocks(np.diff(text_buffer(batch.column(1))[1]).tolist(), SHARD_BYTES):
                part = batch.slice(a, b - a)
                yield pa.RecordBatch.from_arrays([part.column(0), *shard(part.column(1))], ["key", *names])

    return slim.mapInArrow(run, f"key {kind}, " + ", ".join(f"{x} bigint" for x in names)).withColumnRenamed("key", key)


def judge(measured: DataFrame, most_covered: float = MOST_COVERED, longest: int = LONGEST) -> DataFrame:
    """measured, with base_failed and kept."""
    words = F.col("n_words")
    base = (words < 50) | (100 * F.col("n_repeat_words") > 50 * words)
    repeats = (F.col("n_covered") > most_covered * words) | (F.col("longest") > longest)
    return measured.withColumns({"base_failed": base, "kept": ~base & ~repeats})
