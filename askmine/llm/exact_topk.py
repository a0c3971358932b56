"""Exact top-k by inner product, in three phases with one threshold for all lists.

Components are turned to the integers floor(SCALE * x). A query's score of a candidate is the sum over LISTS lists, one for
each run of dimensions. Queries and candidates are dealt to blocks by a hash of their row, and a cell has one block of
each; the lists of a cell's candidates lie in that cell, since a row has all its dimensions.

1. Each cell takes the k best entries of each of a query's lists, with their whole scores, and keeps the k best of those.
   Gathered over all cells, the k-th of them is a score that the answer's last can't be below.
2. That score, divided by the number of lists, goes to all cells with the query: a candidate that is below it in every
   list sums to less. Each cell collects the entries of each list that reach it.
3. Of these alone the other lists are summed, exactly. Those that reach the score of phase 1 stay, k in a cell at most, and
   the k best of all cells are the answer. A query with fewer than k candidates has no threshold and keeps all.

Vectors that are null or hold a null or a component that isn't finite take no part; of two lengths the shorter one counts as
filled up with zeros; an empty vector scores 0. Rows that repeat, or share an id, are queries and candidates of their own;
a row isn't its own candidate. Rows with a null id are candidates only, and come last among equals. Scores are integers as
long as they fit 64 bits, and an error beyond. An empty table, or one row, gives no rows. Other columns aren't read.

Nothing but two counts reaches the driver. A query has k rows a block of candidates at most; the k best are taken before
and after the shuffle. Work grows with queries times candidates, that of a task does not, nor does its memory.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from askmine.llm.base import blocks_for, checkpointed, quoted

SCALE, LISTS = 64, 2
#: Rows of a block of queries and of candidates; candidates are also dealt so that few rows still keep MIN_BLOCKS tasks busy.
QUERY_BLOCK, CANDIDATE_BLOCK, MIN_BLOCKS, MIN_ROWS = 16_384, 8_192, 8, 1_024
#: Pairs that a task holds at a time.
TILE = 1 << 21
LOWEST = -(1 << 62)


def prepared(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", scale: int = SCALE) -> DataFrame:
    """row (a number of its own), id and the whole components, as doubles, of the vectors that take part; kept in a checkpoint."""
    components = F.col(quoted(vector)).cast("array<double>")
    bad = F.exists("x", lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    whole = F.transform("x", lambda c: _floor(c * scale))
    kept = vectors.select(F.col(quoted(key)).cast("bigint").alias("id"), components.alias("x")).filter(F.col("x").isNotNull() & ~bad)
    return checkpointed(kept.select(F.monotonically_increasing_id().alias("row"), "id", whole.alias("x")))


def _floor(value: Column) -> Column:
    """floor as a double: beyond 2^53 every double is whole."""
    return F.when(F.abs(value) < float(1 << 53), F.floor(value).cast("double")).otherwise(value)


def matrix(column: pa.Array, width: int) -> np.ndarray:
    """A row per list of doubles, filled up with zeros."""
    sizes = column.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    out = np.zeros((len(sizes), width))
    row = np.repeat(np.arange(len(sizes)), sizes)
    out[row, np.arange(len(row)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = column.flatten().to_numpy(zero_copy_only=False)
    return out


class Cell:
    """One block of queries and one of candidates, whose lists are scored tile by tile."""

    def __init__(self, queries: pa.Table, candidates: pa.Table, n_lists: int) -> None:
        q, c = (t.column("x").combine_chunks() for t in (queries, candidates))
        q, c = (pa.concat_arrays(x.chunks) if isinstance(x, pa.ChunkedArray) else x for x in (q, c))
        width = max([1, *(int(x.value_lengths().to_numpy(zero_copy_only=False).max(initial=0)) for x in (q, c))])
        q, c = matrix(q, width), matrix(c, width)
        most = width * float(np.abs(q).max(initial=0)) * float(np.abs(c).max(initial=0))
        kind = np.float32 if most < 1 << 24 else np.float64 if most < 1 << 53 else object
        whole = np.vectorize(int, otypes=[object]) if kind is object else lambda x: x.astype(kind)
        self.q, self.c = whole(q), whole(c)
        self.segments = [slice(int(s[0]), int(s[-1]) + 1) for s in np.array_split(np.arange(width), n_lists) if len(s)]
        self.rows = [t.column("row").to_numpy() for t in (queries, candidates)]

    def tiles(self) -> Iterator[tuple[slice, list[np.ndarray]]]:
        """Queries at a time, and their scores in each list."""
        step = max(1, TILE // max(1, len(self.c)))
        for start in range(0, len(self.q), step):
            at = slice(start, min(start + step, len(self.q)))
            yield at, [self.q[at, s] @ self.c[:, s].T for s in self.segments]

    def whole(self, query: np.ndarray, candidate: np.ndarray) -> np.ndarray:
        """The whole scores of some pairs, as 64-bit integers."""
        out = np.empty(len(query), np.int64)
        step = max(1, TILE // self.q.shape[1])
        for start in range(0, len(query), step):
            at = slice(start, start + step)
            sums = (self.q[query[at]] * self.c[candidate[at]]).sum(1)
            if sums.dtype == object and any(abs(int(x)) >= 1 << 62 for x in sums):
                raise OverflowError("an inner product doesn't fit 62 bits")
            out[at] = sums.astype(np.int64)
        return out


def _best_of_lists(cell: Cell, k: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Phase 1 in a cell: (queries, their scores, k at most each) of the entries that are among the k best of a list."""
    n = len(cell.c)
    for at, lists in cell.tiles():
        take = min(k + 1, n)  # one more, as the query's own row may be among them
        best = [np.argpartition(-x, take - 1, axis=1)[:, :take] if take < n else np.tile(np.arange(n), (len(x), 1)) for x in lists]
        found = np.sort(np.concatenate(best, axis=1), axis=1)
        again = np.zeros(found.shape, bool)
        again[:, 1:] = found[:, 1:] == found[:, :-1]
        query = np.repeat(np.arange(at.start, at.stop), found.shape[1])
        scores = cell.whole(query, found.ravel()).reshape(found.shape)
        scores[again | (cell.rows[1][found] == cell.rows[0][at][:, None])] = LOWEST
        yield np.arange(at.start, at.stop), -np.sort(-scores, axis=1)[:, :k]


def _reaching(cell: Cell, cutoff: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Phases 2 and 3 in a cell: (query, candidate, score) of the entries whose whole score reaches the query's cutoff."""
    share = -(-cutoff // len(cell.segments))  # rounded up: scores are whole
    for at, lists in cell.tiles():
        hit = np.zeros(lists[0].shape, bool)
        for scores in lists:
            hit |= scores >= share[at, None]
        query, candidate = np.nonzero(hit)
        query += at.start
        scores = cell.whole(query, candidate)
        kept = (scores >= cutoff[query]) & (cell.rows[1][candidate] != cell.rows[0][query])
        yield query[kept], candidate[kept], scores[kept]


def _best_of_each(query: np.ndarray, score: np.ndarray, identity: np.ndarray, row: np.ndarray, k: int) -> np.ndarray:
    """Places of the k best of each query: by score, then the smaller id, then the row."""
    order = np.lexsort((row, identity, -score, query))
    ordered = query[order]
    first = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]])) if len(ordered) else np.zeros(0, np.int64)
    rank = np.arange(len(ordered)) - np.repeat(first, np.diff(np.append(first, len(ordered))))
    return order[rank < k]


def top_k(vectors: DataFrame, k: int = 20, is_query: Column | None = None, key: str = "vec_id", vector: str = "embedding", scale: int = SCALE, lists: int = LISTS, block: int = CANDIDATE_BLOCK) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: each query's k best candidates among all other rows.

    is_query: a condition on the column ``id``; by default, ids divisible by 20.
    """
    rows = prepared(vectors, key, vector, scale)
    asks = F.coalesce(F.pmod("id", F.lit(20)) == 0 if is_query is None else is_query, F.lit(False)) & F.col("id").isNotNull()
    size = rows.agg(F.count(F.lit(1)).alias("n"), F.count_if(asks).alias("q")).first()
    n_c = max(blocks_for(size["n"], block), min(MIN_BLOCKS, blocks_for(size["n"], MIN_ROWS)))
    n_q = blocks_for(size["q"], QUERY_BLOCK)
    dealt = lambda n, seed: F.pmod(F.xxhash64("row", F.lit(seed)), F.lit(n))
    named = lambda rows: rows.select(*[F.col(c).alias(c) for c in rows.columns])  # noqa: E731  both sides of a cell come from one table
    candidates = named(rows).withColumn("c", dealt(n_c, 1)).withColumn("g", F.explode(F.sequence(F.lit(0), F.lit(n_q - 1)))).withColumn("cell", F.col("g") * n_c + F.col("c")).groupBy("cell")

    def in_cells(queries: DataFrame, work, schema: str) -> DataFrame:
        spread = named(queries).withColumn("g", dealt(n_q, 2)).withColumn("c", F.explode(F.sequence(F.lit(0), F.lit(n_c - 1)))).withColumn("cell", F.col("g") * n_c + F.col("c"))
        return spread.groupBy("cell").cogroup(candidates).applyInArrow(work, schema)

    def gather(asked: pa.Table, held: pa.Table) -> pa.Table:
        out = [(np.zeros(0, np.int64), np.zeros(0, np.int64))]
        if asked.num_rows and held.num_rows:
            cell = Cell(asked, held, lists)
            for query, scores in _best_of_lists(cell, k):
                there = scores > LOWEST
                out.append((np.repeat(cell.rows[0][query], there.sum(1)), scores[there]))
        return pa.table([np.concatenate(x) for x in zip(*out)], ["row", "score"])

    def collect(asked: pa.Table, held: pa.Table) -> pa.Table:
        names = ["row", "query_id", "vec_id", "other", "score"]
        out = [pa.table([pa.array([], pa.int64())] * 5, names)]
        if asked.num_rows and held.num_rows:
            cell, ids, own = Cell(asked, held, lists), held.column("id"), asked.column("id")
            order = np.where(ids.is_null().to_numpy(), np.iinfo(np.int64).max, ids.fill_null(0).to_numpy())
            for query, candidate, score in _reaching(cell, asked.column("cutoff").to_numpy()):
                best = _best_of_each(query, score, order[candidate], cell.rows[1][candidate], k)
                query, candidate = query[best], candidate[best]
                out.append(pa.table([pa.array(cell.rows[0][query]), own.take(pa.array(query)), ids.take(pa.array(candidate)), pa.array(cell.rows[1][candidate]), pa.array(score[best])], names))
        return pa.concat_tables(out)

    queries = rows.filter(asks)
    by_score = Window.partitionBy("row").orderBy(F.desc("score"))
    gathered = in_cells(queries, gather, "row bigint, score bigint").withColumn("rank", F.row_number().over(by_score))
    cutoffs = gathered.filter(F.col("rank") <= k).groupBy("row").agg(F.min("score").alias("score"), F.count(F.lit(1)).alias("n"))
    safe = F.when(F.col("n") == k, F.col("score")).otherwise(F.lit(LOWEST)).alias("cutoff")
    cut = queries.join(cutoffs.select("row", safe), "row", "left").withColumn("cutoff", F.coalesce("cutoff", F.lit(LOWEST)))
    found = in_cells(cut, collect, "row bigint, query_id bigint, vec_id bigint, other bigint, score bigint")
    best = Window.partitionBy("row").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"), F.asc("other"))
    return found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
