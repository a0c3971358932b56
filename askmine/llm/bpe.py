"""Byte-level BPE encoding and decoding.

Pre-tokens are found without a regex. Each code point gets a class (letter, number, other, blank, white space, and an
apostrophe that opens a contraction); an automaton of eight states reads the classes. Each class is a function from
states to states; those functions and all their compositions form a small monoid, so that a prefix scan over one-byte
monoid elements (composition is associative) gives the state before each code point, and a table the pre-token starts.
The slices between starts go through a bounded cache of merged pairs.

Rows: a null text encodes as an empty text (no ids). Equal texts and repeated rows give equal ids. A text of any
length is encoded whole; texts are batched by size, so that a very long one stands alone. An empty table gives no rows.
Only the key and the text column are read, so that other columns, whatever their names, don't matter.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import sys
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from askmine.llm.base import quoted, release, row_blocks, text_buffer, texts_of, with_fields

LETTER, NUMBER, OTHER, SHORT, LONG, BLANK_LAST, SPACE_LAST, SPACE_MORE, BREAK = range(9)
#: White space of the pattern's \s class (the Unicode property White_Space).
WHITE_SPACE = [*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
#: What may follow an apostrophe as a contraction of one letter, and of two.
ONE_LETTER, TWO_LETTERS = "stmd", ("re", "ve", "ll")
#: Ranges of letters and numbers that Unicode gained after the version of the unicodedata module here.
NEW_LETTERS = (
    (0x1C89, 0x1C8A), (0xA7CB, 0xA7CD), (0xA7DA, 0xA7DC), (0x105C0, 0x105F3), (0x10D4A, 0x10D65), (0x10D6F, 0x10D85), (0x10EC2, 0x10EC4),
    (0x11380, 0x11389), (0x1138B, 0x1138B), (0x1138E, 0x1138E), (0x11390, 0x113B5), (0x113B7, 0x113B7), (0x113D1, 0x113D1), (0x113D3, 0x113D3),
    (0x11BC0, 0x11BE0), (0x13460, 0x143FA), (0x16100, 0x1611D), (0x16D40, 0x16D6C), (0x18CFF, 0x18CFF), (0x1E5D0, 0x1E5ED), (0x1E5F0, 0x1E5F0),
)
NEW_NUMBERS = ((0x10D40, 0x10D49), (0x116D0, 0x116E3), (0x11BF0, 0x11BF9), (0x16130, 0x16139), (0x16D70, 0x16D79), (0x1CCF0, 0x1CCF9), (0x1E5F1, 0x1E5FA))
#: States: nothing open, in letters, in numbers, in others, after a blank that joins what follows, in white space, and with one or two letters of a contraction to come.
NONE, IN_LETTERS, IN_NUMBERS, IN_OTHERS, JOINED, IN_SPACE, ONE_LEFT, TWO_LEFT = range(8)
#: Code points per scan, and pieces that a worker's cache holds.
SCAN_CHARS, CACHE_PIECES = 1 << 20, 400_000


def _automaton() -> tuple[np.ndarray, np.ndarray]:
    """(next state, whether a pre-token starts) by state and class."""
    step = np.zeros((8, 9), np.uint8)
    starts = np.ones((8, 9), bool)
    for kind, own, after in ((LETTER, IN_LETTERS, IN_LETTERS), (NUMBER, IN_NUMBERS, IN_NUMBERS), (OTHER, IN_OTHERS, IN_OTHERS), (SHORT, IN_OTHERS, ONE_LEFT), (LONG, IN_OTHERS, TWO_LEFT)):
        step[:, kind] = after
        step[[own, JOINED], kind] = own
        starts[[own, JOINED], kind] = False
    step[[ONE_LEFT, TWO_LEFT], LETTER] = NONE, ONE_LEFT
    starts[[ONE_LEFT, TWO_LEFT], LETTER] = False
    step[:, BLANK_LAST], step[:, SPACE_LAST], step[:, SPACE_MORE], step[:, BREAK] = JOINED, NONE, IN_SPACE, NONE
    starts[IN_SPACE, SPACE_MORE] = False
    return step, starts


def _monoid(step: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(element of each class, composition table, the elements as functions), closed under composition."""
    functions = [tuple(range(len(step)))]
    number = {functions[0]: 0}
    generators = [tuple(int(x) for x in step[:, c]) for c in range(step.shape[1])]
    for f in functions:
        for g in generators:
            h = tuple(g[x] for x in f)
            if h not in number:
                number[h] = len(functions)
                functions.append(h)
    if len(functions) > 256:
        raise AssertionError("the transition monoid no longer fits one byte")
    table = np.array([[number[tuple(g[x] for x in f)] for g in functions] for f in functions], np.uint8)
    return np.array([number[g] for g in generators], np.uint8), table, np.array(functions, np.uint8)


STEP, STARTS = _automaton()
ELEMENT, COMPOSE, ACT = _monoid(STEP)
_CLASSES: list[np.ndarray] = []


def class_table() -> np.ndarray:
    """The class of every code point, from the Unicode general categories; made once in a worker."""
    if not _CLASSES:
        kinds = {"L": LETTER, "N": NUMBER}
        category = unicodedata.category
        table = np.fromiter((kinds.get(category(chr(c))[0], OTHER) for c in range(sys.maxunicode + 1)), np.uint8, sys.maxunicode + 1)
        table[WHITE_SPACE] = SPACE_LAST
        for kind, ranges in ((LETTER, NEW_LETTERS), (NUMBER, NEW_NUMBERS)):
            for first, last in ranges:
                table[first : last + 1] = kind
        _CLASSES.append(table)
    return _CLASSES[0]


def scan(elements: np.ndarray, width: int = 64) -> np.ndarray:
    """Inclusive prefix compositions of monoid elements: within columns, over column totals, then joined."""
    n = len(elements)
    if n <= width:
        out = elements.copy()
        for i in range(1, n):
            out[i] = COMPOSE[out[i - 1], elements[i]]
        return out
    rows = -(-n // width)
    grid = np.zeros(rows * width, np.uint8)
    grid[:n] = elements
    grid = np.ascontiguousarray(grid.reshape(rows, width).T)
    flat = COMPOSE.ravel()
    size = len(COMPOSE)
    for i in range(1, width):
        grid[i] = flat[grid[i - 1].astype(np.intp) * size + grid[i]]
    before = np.zeros(rows, np.uint8)
    before[1:] = scan(grid[-1], width)[:-1]
    joined = flat[before.astype(np.intp)[None, :] * size + grid]
    return joined.T.reshape(-1)[:n]


def classify(points: np.ndarray, is_break: np.ndarray) -> np.ndarray:
    """Classes with what follows folded in: the last white space of a run, and the apostrophes of contractions."""
    kinds = class_table()[points]
    kinds[is_break] = BREAK
    space = kinds == SPACE_LAST
    after = np.zeros(len(kinds), bool)
    after[:-1] = (kinds[1:] != SPACE_LAST) & (kinds[1:] != BREAK)
    kinds[space & (points == 0x20)] = BLANK_LAST
    kinds[space & ~after] = SPACE_MORE
    quotes = np.flatnonzero(points == 0x27)
    if len(quotes):
        padded = np.concatenate([points, np.zeros(2, points.dtype)])
        padded[: len(points)][is_break] = 0
        one, two = padded[quotes + 1], padded[quotes + 2]
        kinds[quotes[np.isin(one, [ord(c) for c in ONE_LETTER])]] = SHORT
        for pair in TWO_LETTERS:
            kinds[quotes[(one == ord(pair[0])) & (two == ord(pair[1]))]] = LONG
    return kinds


def piece_starts(texts: list[str]) -> list[np.ndarray]:
    """The starts (code points) of each text's pre-tokens, of all texts in one scan."""
    lengths = np.fromiter(map(len, texts), np.int64, len(texts))
    joined = "\x00".join(texts) + "\x00"
    points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    ends = np.cumsum(lengths + 1) - 1
    is_break = np.zeros(len(points), bool)
    is_break[ends] = True
    kinds = classify(points, is_break)
    states = np.zeros(len(kinds), np.uint8)
    states[1:] = ACT[scan(ELEMENT[kinds])[:-1], NONE]
    found = np.flatnonzero(STARTS[states, kinds] & ~is_break)
    cuts = np.searchsorted(found, ends)
    return [found[a:b] - e + n for a, b, e, n in zip(np.concatenate([[0], cuts[:-1]]), cuts, ends, lengths)]


def merged(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Merge the adjacent pair of lowest rank, leftmost first, until none is known."""
    whole = ranks.get(piece)
    if whole is not None:
        return [whole]
    if len(piece) > 96:
        return _merged_long(piece, ranks)
    parts = [piece[i : i + 1] for i in range(len(piece))]
    scores = [ranks.get(piece[i : i + 2], 1 << 30) for i in range(len(piece) - 1)]
    while scores:
        low = min(scores)
        if low == 1 << 30:
            break
        i = scores.index(low)
        parts[i : i + 2] = [parts[i] + parts[i + 1]]
        del scores[i]
        if i:
            scores[i - 1] = ranks.get(parts[i - 1] + parts[i], 1 << 30)
        if i < len(scores):
            scores[i] = ranks.get(parts[i] + parts[i + 1], 1 << 30)
    return [ranks[p] for p in parts]


def _merged_long(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The same with a heap over a linked list, so that a piece of n bytes takes n log n steps."""
    n = len(piece)
    end = list(range(1, n + 1))  # where the part that starts here ends; 0 once merged away
    before = list(range(-1, n - 1))
    heap = [(r, i, i + 1, i + 2) for i in range(n - 1) if (r := ranks.get(piece[i : i + 2])) is not None]
    heapq.heapify(heap)
    while heap:
        _, i, middle, stop = heapq.heappop(heap)
        if end[i] != middle or middle >= n or end[middle] != stop:
            continue
        end[i], end[middle] = stop, 0
        if stop < n:
            before[stop] = i
            if (r := ranks.get(piece[i : end[stop]])) is not None:
                heapq.heappush(heap, (r, i, stop, end[stop]))
        if (p := before[i]) >= 0 and (r := ranks.get(piece[p:stop])) is not None:
            heapq.heappush(heap, (r, p, i, stop))
    out, i = [], 0
    while i < n:
        out.append(ranks[piece[i : end[i]]])
        i = end[i]
    return out


class Vocabulary:
    """Ranks and byte strings of a rank file, with a bounded cache of encoded pieces."""

    def __init__(self, rank_file: bytes):
        self.ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in rank_file.splitlines() if line)}
        size = max(self.ranks.values()) + 1
        tokens = [b""] * size
        for token, rank in self.ranks.items():
            tokens[rank] = token
        self.lengths = np.fromiter(map(len, tokens), np.int64, size)
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.bytes = np.frombuffer(b"".join(tokens), np.uint8)
        self.pieces = _Pieces(self.ranks)

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        out = []
        known = self.pieces
        for text, starts in zip(texts, piece_starts(texts)):
            if len(known) > CACHE_PIECES:
                known.clear()
            at = starts.tolist()
            out.append(np.frombuffer(b"".join([known[text[a:b]] for a, b in zip(at, [*at[1:], len(text)])]), "<u4"))
        return out

    def decode(self, ids: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """The bytes of the ids; ends has the byte offset at which each token ends."""
        if not len(ids):
            return np.zeros(0, np.uint8)
        ends = ends.astype(np.int64)
        lengths = np.diff(ends, prepend=0)
        return self.bytes[np.arange(ends[-1]) + np.repeat(self.starts[ids] - (ends - lengths), lengths)]


class _Pieces(dict):
    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks

    def __missing__(self, piece: str) -> bytes:
        ids = self[piece] = np.array(merged(piece.encode("utf-8", "surrogatepass"), self.ranks), "<u4").tobytes()
        return ids


_LOADED: dict[str, Vocabulary] = {}


def _vocabulary(shared) -> Vocabulary:
    """The worker's vocabulary of a rank file, known by the file's digest."""
    name, content = shared.value
    if name not in _LOADED:
        _LOADED.clear()
        _LOADED[name] = Vocabulary(content)
    return _LOADED[name]


def forget() -> None:
    """Let the vocabulary and its pieces go at a task's end: the worker may serve other operators next."""
    _LOADED.clear()
    release()


def _shared(docs: DataFrame, path: str):
    """The rank file, read by the driver; a vocabulary is of a fixed size, and checked to be small."""
    with open(path, "rb") as f:
        content = f.read()
    if len(content) > 64 << 20:
        raise ValueError(f"{path} is no vocabulary of a size to broadcast")
    return docs.sparkSession.sparkContext.broadcast((hashlib.sha256(content).hexdigest(), content))


def encode(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, ids (little-endian unsigned 32-bit), ends (byte offset at which each token ends, likewise), n_tokens."""
    shared = _shared(docs, path)
    slim = docs.select(F.col(quoted(key)).alias("key"), F.col(quoted(text)).cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = _vocabulary(shared)
        for batch in batches:
            _, offsets = text_buffer(batch.column(1))
            for a, b in row_blocks(np.diff(offsets).tolist(), SCAN_CHARS):
                ids = vocabulary.encode(texts_of(batch.column(1).slice(a, b - a)))
                ends = [np.cumsum(vocabulary.lengths[x]).astype("<u4") for x in ids]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a), pa.array([x.tobytes() for x in ids], pa.binary()), pa.array([x.tobytes() for x in ends], pa.binary()), pa.array([len(x) for x in ids], pa.int64())],
                    ["key", "ids", "ends", "n_tokens"],
                )
            release()
        del vocabulary
        forget()

    return slim.mapInArrow(run, with_fields(slim.schema[:1], "ids binary, ends binary, n_tokens bigint")).withColumnRenamed("key", key)


def decode(encoded: DataFrame, path: str, key: str = "doc_id") -> DataFrame:
    """encoded, with the decoded bytes in place of the offsets."""
    shared = _shared(encoded, path)
    slim = encoded.select(F.col(quoted(key)).alias("key"), "ids", "ends", "n_tokens")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = _vocabulary(shared)
        for batch in batches:
            sizes = [4 * n or 1 for n in batch.column(3).to_pylist()]
            for a, b in row_blocks(sizes, SCAN_CHARS * 2):
                part = batch.slice(a, b - a)
                texts = [vocabulary.decode(np.frombuffer(i, "<u4"), np.frombuffer(e, "<u4")).tobytes() for i, e in zip(part.column(1).to_pylist(), part.column(2).to_pylist())]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), part.column(3), pa.array(texts, pa.binary())], ["key", "ids", "n_tokens", "decoded"])
            release()
        del vocabulary
        forget()

    return slim.mapInArrow(run, with_fields(slim.schema[:1], "ids binary, n_tokens bigint, decoded binary")).withColumnRenamed("key", key)


def round_trip(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """What decode(encode(docs)) gives, with both in one Python worker: key, ids, n_tokens, decoded."""
    shared = _shared(docs, path)
    slim = docs.select(F.col(quoted(key)).alias("key"), F.col(quoted(text)).cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = _vocabulary(shared)
        for batch in batches:
            _, offsets = text_buffer(batch.column(1))
            for a, b in row_blocks(np.diff(offsets).tolist(), SCAN_CHARS):
                ids = vocabulary.encode(texts_of(batch.column(1).slice(a, b - a)))
                texts = [vocabulary.decode(x, np.cumsum(vocabulary.lengths[x])).tobytes() for x in ids]
                columns = [pa.array([x.tobytes() for x in ids], pa.binary()), pa.array([len(x) for x in ids], pa.int64()), pa.array(texts, pa.binary())]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), *columns], ["key", "ids", "n_tokens", "decoded"])
            release()
        del vocabulary
        forget()

    return slim.mapInArrow(run, with_fields(slim.schema[:1], "ids binary, n_tokens bigint, decoded binary")).withColumnRenamed("key", key)
