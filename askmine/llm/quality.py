"""Quality classifier: ridge regression on random Fourier features of document statistics, with isotonic calibration.

Each text gives a vector of statistics. Standardised by their means and deviations over all rows, they pass through
random Fourier features, cos(w.x + b) with normal w, whose inner products approximate a Gaussian kernel. Every labelled
training row adds to the normal equations; each partition sums its own, and Spark adds the sums row by row of the
matrix, so that the driver gets one matrix of a fixed size. The scores of the training rows are counted in BINS bins, to
which the isotonic fit is made.

Empty, blank and null texts have statistics of zero and are scored like any other. Rows with a null label aren't learnt
from. Without any label all scores are 0.5. Repeated rows each get a score. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from askmine.llm.base import checkpointed, quoted, row_blocks, text_buffer, with_fields
from askmine.llm.blocks import mixed
from askmine.llm.calibrate import calibrated, isotonic
from askmine.llm.repetition import covered, duplicate_lines, shared_prefixes
from askmine.llm.substring_dedup import IS_SPACE, word_bounds, word_hashes

STATISTICS = (
    "log_bytes", "log_words", "word_length", "word_length_deviation", "upper", "digits", "marks", "loud", "stops", "lines", "not_ascii",
    "capitals", "short_words", "marked_words", "bare_marks", "distinct_words", "same_as_before", "repeated", "repeated_long", "dup_lines",
    "sentence_ends", "letters", "vowels",
)
#: Random features, the kernel's width in standard deviations, the ridge, bins of scores, and groups in which partitions' sums meet.
FEATURES, WIDTH, RIDGE, BINS, SUMMING = 256, 6.0, 1.0, 2048, 64
SEED, SHARD_BYTES = 20240229, 2 << 20


def _flags(members: bytes) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(members)] = True
    return out


UPPER, DIGIT, STOP, LOUD = _flags(bytes(range(65, 91))), _flags(b"0123456789"), _flags(b".,;:"), _flags(b"!?")
LETTER = _flags(bytes(range(65, 91)) + bytes(range(97, 123)))
MARK, VOWEL = _flags(b"#*$%&|<>{}[]~^_=+@\\/"), _flags(b"aeiouAEIOU")


def statistics(column: pa.Array) -> np.ndarray:
    """A row of STATISTICS for each text."""
    raw, ends = text_buffer(column)
    lengths = np.diff(ends)
    n = len(lengths)
    own = raw[ends[0] : ends[-1]]
    data = np.full(len(own) + n, 0x20, np.uint8)
    data[np.arange(len(own), dtype=np.int64) + np.repeat(np.arange(n), lengths)] = own
    text_end = np.cumsum(lengths + 1)
    edges = np.concatenate([[0], text_end])
    per_text = lambda flags: np.diff(np.concatenate([[0], np.cumsum(flags)])[edges])
    start, end = word_bounds(data, IS_SPACE)
    doc = np.searchsorted(text_end, start, "right")
    size = end - start
    words = np.bincount(doc, minlength=n)
    some = np.maximum(words, 1)
    per_word = lambda values: np.bincount(doc, weights=values, minlength=n) / some
    total = np.maximum(per_text(~IS_SPACE[data]), 1)
    hashes = word_hashes(data, start, end) if len(start) else np.zeros(0, np.uint64)
    own_hashes = mixed(hashes ^ mixed(doc.astype(np.uint64) + np.uint64(1)))
    shared = shared_prefixes(own_hashes)
    three, eight = np.flatnonzero(shared >= 3), np.flatnonzero(shared >= 8)
    distinct = np.unique(own_hashes, return_index=True)[1]
    before = np.zeros(len(start), bool)
    before[1:] = own_hashes[1:] == own_hashes[:-1]
    marks = np.concatenate([[0], np.cumsum(MARK[data])])
    marked = marks[end] - marks[start]
    mean = per_word(size)
    last = data[end - 1] if len(end) else data[:0]
    first = data[start] if len(start) else data[:0]
    lines = per_text(data == 10)
    dup = np.array([duplicate_lines(raw[a:b].tobytes()) for a, b in zip(ends[:-1], ends[1:])], float)
    letters = np.maximum(per_text(LETTER[data]), 1)
    return np.column_stack([
        np.log1p(lengths), np.log1p(words), mean, np.sqrt(np.maximum(per_word(size.astype(float) ** 2) - mean**2, 0)), per_text(UPPER[data]) / letters, per_text(DIGIT[data]) / total,
        per_text(MARK[data]) / total, per_text(LOUD[data]) / total, per_text(STOP[data]) / total, lines / some, per_text((data & 0xC0) == 0x80) / total,
        per_word(UPPER[first]), per_word(size <= 3), per_word(marked > 0), per_word(marked == size), np.bincount(doc[distinct], minlength=n) / some, per_word(before),
        per_word(covered(three, np.full(len(three), 3), len(start))), per_word(covered(eight, shared[eight], len(start))), dup / (lines + 1),
        per_word(np.isin(last, list(b".!?"))), letters / total, per_text(VOWEL[data]) / letters,
    ]).astype(np.float64)


def measured(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, stats (array of doubles)."""
    slim = docs.select(F.col(quoted(key)).alias("key"), F.col(quoted(text)).cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in row_blocks(np.diff(text_buffer(batch.column(1))[1]).tolist(), SHARD_BYTES):
                part = batch.slice(a, b - a)
                yield pa.RecordBatch.from_arrays([part.column(0), _lists(statistics(part.column(1)))], ["key", "stats"])

    return slim.mapInArrow(run, with_fields(slim.schema[:1], "stats array<double>"))


def _lists(rows: np.ndarray) -> pa.Array:
    n, width = rows.shape
    return pa.ListArray.from_arrays(pa.array(np.arange(n + 1) * width, pa.int32()), pa.array(rows.ravel()))


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


class Fourier:
    """Standardisation and random features, with a constant one."""

    def __init__(self, mean: np.ndarray, deviation: np.ndarray, features: int, width: float):
        rng = np.random.default_rng(SEED)
        self.mean, self.deviation = mean, np.where(deviation > 1e-12, deviation, 1.0)
        self.weights = rng.normal(size=(len(mean), features)) / width
        self.phases = rng.uniform(0, 2 * np.pi, features)

    def __call__(self, stats: np.ndarray) -> np.ndarray:
        x = np.clip((stats - self.mean) / self.deviation, -8, 8)
        z = np.cos(x @ self.weights + self.phases) * np.sqrt(2 / len(self.phases))
        return np.column_stack([z, np.ones(len(z))])


def normal_equations(train: DataFrame, fourier: Fourier) -> tuple[np.ndarray, np.ndarray]:
    """Z'Z and Z'y of train's (stats, label), summed by partitions and then by matrix rows."""
    width = len(fourier.phases) + 1

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((width, width + 1))
        for batch in batches:
            for a in range(0, batch.num_rows, 8192):
                part = batch.slice(a, 8192)
                z = fourier(_matrix(part.column(0)))
                total += z.T @ np.column_stack([z, part.column(1).to_numpy(zero_copy_only=False)])
        part = TaskContext.get().partitionId() % SUMMING
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(width), pa.int32()), pa.array(np.full(width, part), pa.int32()), pa.array([r.tobytes() for r in total], pa.binary())], ["i", "part", "sums"])

    def add(key: tuple, rows: pa.Table) -> pa.Table:
        added = np.sum([np.frombuffer(x) for x in rows["sums"].to_pylist()], axis=0).tobytes()
        return pa.table({"i": pa.array([key[0].as_py()], pa.int32()), "sums": pa.array([added], pa.binary())})

    # each partition sums its own rows where they are; their sums meet in SUMMING groups a matrix row, and then in one
    own = train.select("stats", "label").mapInArrow(sums, "i int, part int, sums binary")
    rows = own.groupBy("i", "part").applyInArrow(add, "i int, sums binary").groupBy("i").applyInArrow(add, "i int, sums binary").collect()  # width rows of a fixed size
    total = np.zeros((width, width + 1))
    for row in rows:
        total[row["i"]] = np.frombuffer(bytes(row["sums"]))
    return total[:, :-1], total[:, -1]


def _scored(df: DataFrame, fourier: Fourier, weights: np.ndarray, knots=None) -> DataFrame:
    """key, the other columns but stats, and score (raw without knots)."""
    others = [f for f in df.schema if f.name != "stats"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            score = np.concatenate([np.zeros(0), *(fourier(_matrix(batch.column(0).slice(a, 8192))) @ weights for a in range(0, batch.num_rows, 8192))])
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], pa.array(score if knots is None else calibrated(score, knots))], [*(f.name for f in others), "score"])

    return df.select("stats", *[f.name for f in others]).mapInArrow(run, with_fields(others, "score double"))


def score(docs: DataFrame, labels: DataFrame, label: str = "quality", learn: Column | None = None, key: str = "doc_id", text: str = "text", features: int = FEATURES, width: float = WIDTH, ridge: float = RIDGE) -> DataFrame:
    """key, score (0 to 1) of every row; learnt from the labels of rows for which learn, a condition on ``key``, holds."""
    stats = checkpointed(measured(docs, key, text))
    cells = [c for i in range(len(STATISTICS)) for c in (F.avg(F.get("stats", F.lit(i))), F.stddev_pop(F.get("stats", F.lit(i))))]
    row = [x or 0.0 for x in stats.agg(*cells).first()]
    fourier = Fourier(np.array(row[::2]), np.array(row[1::2]), features, width)
    known = labels.select(F.col(key).alias("key"), F.col(label).cast("double").alias("label")).filter("label is not null")
    train = stats.join(known, "key")
    if learn is not None:
        train = train.withColumnRenamed("key", key).filter(learn).withColumnRenamed(key, "key")
    a, b = normal_equations(train, fourier)
    weights = np.linalg.solve(a + ridge * np.eye(len(a)), b)
    bin_ = F.floor(F.least(F.greatest("score", F.lit(-0.5)), F.lit(1.5)) * (BINS // 2))
    bins = _scored(train.select("key", "stats", "label"), fourier, weights).groupBy(bin_.alias("bin")).agg(F.count(F.lit(1)).alias("n"), F.avg("label").alias("y"), F.avg("score").alias("x")).collect()  # BINS rows at most
    knots = isotonic(*(np.array([r[c] for r in bins], float) for c in ("x", "y", "n")))
    return _scored(stats, fourier, weights, knots).select(F.col("key").alias(key), "score")
