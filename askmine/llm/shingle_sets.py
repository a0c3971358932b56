"""Near-duplicates by the similarity of shingle sets: candidates from SimHash and from MinHash bands, each verified exactly.

Two texts are linked if their sets of shingles of five words share at least four fifths of their union. Bits of SimHash
can't tell that alone: at a similarity of 0.8 fingerprints differ in about 10 bits, and the grid join carries 4. So texts
also share a cell if BAND_ROWS of their smallest hashes agree in one of BANDS bands; a pair at 0.8 shares none with
probability (1 - 0.8^3)^32, about 1e-10, and a closer pair with less.

Equal sets are one node. Two rounds take a number of candidates linear in a cell's rows: each with the cell's first and with
the one before it, by size; then each that these links leave outside the cell's largest component with that component's most
linked row. The third looks at all pairs in a cell that no link has joined into one component yet, and takes those whose
finer sketches (a byte of each of FINE smallest hashes) agree in LEAST_FINE places; a pair at 0.8 has fewer with a
probability of 7e-12. Of sets of up to WHOLE shingles the cell's task has 32 bits of each shingle too; they count no less
than what two sets share, so a pair that falls short by them is no link. A pair below 0.8, of which a large group of loose
copies has very many, is thus spared the join with the whole sets. The task's time still grows with the square of the rows
that stay apart in one cell; what it gives out does not, but for links, and for pairs just below 0.8 of larger sets.

Null, empty and blank texts have the empty set, and link. Fewer words than a shingle: the whole sequence is the one
shingle. A row is known by its key and a hash of its text: rows that repeat a key with other texts count each by
themselves, equal rows are counted, and a null key is one more key, after all others. Texts are read whole. An empty
table gives no rows. Other columns may have any names; they are read only to be handed on.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from askmine.llm import simhash
from askmine.llm.base import checkpointed, joined_hot, quoted, release, row_blocks, row_of, text_buffer, with_fields
from askmine.llm.components import components
from askmine.llm.substring_dedup import IS_SPACE, word_bounds, word_hashes

WORDS_EACH, BANDS, BAND_ROWS = 5, 32, 3
#: Similarity from which two sets are linked, as a fraction.
SHARE = (4, 5)
BLOCK_BYTES = 2 << 20
#: Bytes of the finer sketch, and in how many of them a candidate pair agrees.
FINE, LEAST_FINE = 512, 345
#: Shingles up to which a sketch has 32 bits of each.
WHOLE = 1024
#: Bits of the filter that spares rows a shuffle.
FILTER_BITS = 1 << 24
_LOWER = np.frombuffer(simhash.LOWER, np.uint8)
_FINE_ODD = np.random.default_rng(20261126).integers(1 << 62, 1 << 63, FINE, np.uint64) | np.uint64(1)
_ODD = np.random.default_rng(20240301).integers(1 << 62, 1 << 63, 2 * BANDS * BAND_ROWS + 64, np.uint64) | np.uint64(1)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def shingle_sets(column: pa.Array, words_each: int = WORDS_EACH) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, ends): each text's distinct shingles as sorted 64-bit hashes, and where each text's begin and end."""
    raw, ends = text_buffer(column)
    n, lengths = len(ends) - 1, np.diff(ends)
    own = _LOWER[raw[ends[0] : ends[-1]]]
    data = np.full(len(own) + n, 0x20, np.uint8)
    data[np.arange(len(own), dtype=np.int64) + np.repeat(np.arange(n), lengths)] = own
    start, end = word_bounds(data, IS_SPACE)
    if not len(start):
        return np.zeros(0, np.uint64), np.zeros(n + 1, np.int64)
    doc = np.searchsorted(np.cumsum(lengths + 1), start, "right")
    words = np.append(_mixed(word_hashes(data, start, end).astype(np.uint64)), np.zeros(words_each, np.uint64))
    place = np.append(doc, np.full(words_each, -1))
    at = np.arange(len(start))
    hashes, whole = np.zeros(len(start), np.uint64), np.ones(len(start), bool)
    for k in range(words_each):
        inside = place[at + k] == doc
        hashes += np.where(inside, words[at + k] * _ODD[k], np.uint64(0))
        whole &= inside
    first = np.concatenate([[True], doc[1:] != doc[:-1]])
    keep = whole | first  # a short text's first place stands for all of its words
    hashes, doc = _mixed(hashes[keep]), doc[keep]
    order = np.lexsort((hashes, doc))
    hashes, doc = hashes[order], doc[order]
    once = np.ones(len(hashes), bool)
    once[1:] = (hashes[1:] != hashes[:-1]) | (doc[1:] != doc[:-1])
    hashes, doc = hashes[once], doc[once]
    return hashes, np.searchsorted(doc, np.arange(n + 1))


def _set_hash(hashes: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The hash of each text's set, as in the sketch."""
    n, some = len(ends) - 1, np.flatnonzero(np.diff(ends) > 0)
    node = np.zeros(n, np.uint64)
    if len(some):
        node[some] = _mixed(np.add.reduceat(_mixed(hashes ^ _ODD[-1]), ends[:-1][some]) + np.diff(ends)[some].astype(np.uint64))
    return node


def _sketch(hashes: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of each text a hash of its set, and the cells of its bands."""
    n, some = len(ends) - 1, np.flatnonzero(np.diff(ends) > 0)
    node, cells = _set_hash(hashes, ends), np.zeros((n, BANDS), np.uint64)
    if not len(some):
        return node, cells
    begin = ends[:-1][some]
    for band in range(BANDS):
        cell = np.full(len(some), band + 1, np.uint64)
        for i in range(band * BAND_ROWS, (band + 1) * BAND_ROWS):
            cell = _mixed(cell * _ODD[-2] + np.minimum.reduceat(_mixed(hashes ^ _ODD[8 + i]), begin))
        cells[some, band] = cell
    return node, cells


def _fingerprint(hashes: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Of each text 64 bits, each set if it is set in over half of its shingles."""
    some = np.flatnonzero(np.diff(ends) > 0)
    out = np.zeros(len(ends) - 1, np.uint64)
    if len(some):
        for bit in range(64):
            count = np.add.reduceat((hashes >> np.uint64(bit) & np.uint64(1)).astype(np.int64), ends[:-1][some])
            out[some] |= (2 * count > np.diff(ends)[some]).astype(np.uint64) << np.uint64(bit)
    return out


def maybe_among(keys: DataFrame, *columns: str) -> Column:
    """Whether a row's columns may be those of a row of keys: surely if they are, else seldom. A bitmap of FILTER_BITS, whatever the number of keys."""
    c = F.pmod(F.xxhash64(*columns), F.lit(FILTER_BITS))
    each = keys.select(c.alias("slot"))
    parts = each.groupBy(F.bitmap_bucket_number("slot").alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("slot")).alias("bits")).collect()
    bits = np.zeros(FILTER_BITS // 8 + 8192, np.uint8)  # a bucket has 4,096 bytes; the first may be numbered 1
    for part in parts:
        own = np.frombuffer(bytes(part["bits"]), np.uint8)
        bits[part["bucket"] * len(own) : (part["bucket"] + 1) * len(own)] = own
    shared = keys.sparkSession.sparkContext.broadcast(bits)

    @F.pandas_udf("boolean")
    def among(place: pd.Series) -> pd.Series:
        at = place.to_numpy()
        return pd.Series((shared.value[at >> 3] >> (at & 7).astype(np.uint8) & 1).astype(bool))

    return among(F.bitmap_bucket_number(c) * F.lit(8 * 4096) + F.bitmap_bit_position(c))


def _mapped(hashed: DataFrame, make: Callable, more: str) -> DataFrame:
    """key, hash and what make gives for the texts; hashed: key, hash, text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in row_blocks(np.diff(text_buffer(batch.column(2))[1]).tolist(), BLOCK_BYTES):
                part = batch.slice(a, b - a)
                made = make(part.column(2))
                yield pa.RecordBatch.from_arrays([*part.columns[:2], *made.values()], ["key", "hash", *made])
            release()

    return hashed.select("key", "hash", "text").mapInArrow(run, with_fields(hashed.schema[:2], more))


def _by_cell(rows: DataFrame, columns: list[str], make: Callable[..., list[np.ndarray]], schema: str) -> DataFrame:
    """make of whole cells at a time; rows come by cell, then by size and node."""
    dealt = rows.select("cell", *columns).repartition("cell").sortWithinPartitions("cell", "n", "node")
    names = [x.split()[0] for x in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list[np.ndarray]] = []
        out = lambda found: pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in found], names)
        for batch in batches:
            if not batch.num_rows:
                continue
            held.append([c.to_numpy(zero_copy_only=False) for c in batch.columns])
            if held[-1][0][-1] == held[0][0][0]:
                continue  # one cell goes on
            whole = [np.concatenate(x) for x in zip(*held)]
            cut = np.searchsorted(whole[0], whole[0][-1])
            yield out(make(*(x[:cut] for x in whole)))
            held = [[x[cut:] for x in whole]]
        if held:
            yield out(make(*(np.concatenate(x) for x in zip(*held))))

    return dealt.mapInArrow(run, schema)


def _bounds(cells: np.ndarray) -> np.ndarray:
    return np.flatnonzero(np.concatenate([[True], cells[1:] != cells[:-1], [True]]))


def _close(n: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Whether sets of these sizes can be similar enough."""
    return SHARE[1] * np.minimum(n, m) >= SHARE[0] * np.maximum(n, m)


def _shared(cells: np.ndarray, node: np.ndarray, n: np.ndarray) -> list[np.ndarray]:
    edge = _bounds(cells)
    many = np.repeat(np.diff(edge) > 1, np.diff(edge))
    return [cells[many], node[many], n[many]]


def _linear(cells: np.ndarray, node: np.ndarray, n: np.ndarray) -> list[np.ndarray]:
    edge = _bounds(cells)
    first = np.repeat(edge[:-1], np.diff(edge))
    at = np.arange(len(cells))
    a, b = np.concatenate([first, at - 1]), np.concatenate([at, at])
    ok = (b > np.concatenate([first, first])) & (a >= 0)
    a, b = a[ok], b[ok]
    ok = _close(n[a], n[b])
    return _ordered(node[a[ok]], node[b[ok]])


def _to_hubs(cells: np.ndarray, node: np.ndarray, n: np.ndarray, root: np.ndarray, degree: np.ndarray) -> list[np.ndarray]:
    """Of each cell its largest component's most linked row, with all rows outside that component."""
    edge = _bounds(cells)
    found = [[np.zeros(0, np.int64)] * 2]
    for i in range(len(edge) - 1):
        own = slice(edge[i], edge[i + 1])
        names, of, counts = np.unique(root[own], return_inverse=True, return_counts=True)
        inside = of == counts.argmax()
        hub = np.flatnonzero(inside)[degree[own][inside].argmax()]
        others = np.flatnonzero(~inside & _close(n[own], n[own][hub]))
        found.append(_ordered(node[own][others], np.full(len(others), node[own][hub])))
    return [np.concatenate(x) for x in zip(*found)]


def _fine_sketch(hashes: np.ndarray, ends: np.ndarray) -> list[bytes]:
    """Of each text FINE bytes, each a byte of another smallest hash, 32 bits of each of its cells, and of each shingle of up to WHOLE."""
    some = np.flatnonzero(np.diff(ends) > 0)
    out = np.zeros((len(ends) - 1, FINE), np.uint8)
    for k in range(FINE):
        out[some, k] = np.minimum.reduceat(_mixed(hashes ^ _FINE_ODD[k]), ends[:-1][some]).astype(np.uint8) if len(some) else 0
    cells = _sketch(hashes, ends)[1].astype(np.uint32)
    own = hashes.astype(np.uint32)
    return [a.tobytes() + b.tobytes() + (np.sort(own[i:j]).tobytes() if j - i <= WHOLE else b"") for a, b, i, j in zip(out, cells, ends[:-1], ends[1:])]


def _may_link(n: np.ndarray, sketch: np.ndarray, j: int, at: np.ndarray) -> np.ndarray:
    """Of the rows at those that may be similar enough to row j: all where a set is above WHOLE, else by 32 bits of each shingle."""
    if n[j] > WHOLE or not len(at):
        return at
    shingles = lambda i: np.frombuffer(sketch[i], np.uint32, offset=FINE + 4 * BANDS)
    own, others = shingles(j), [shingles(i) for i in at.tolist()]
    flat = np.concatenate(others)
    found = own[np.minimum(np.searchsorted(own, flat), len(own) - 1)] == flat
    ends = np.cumsum([0, *map(len, others)])
    same = np.diff(np.concatenate([[0], np.cumsum(found)])[ends])
    return at[(n[at] > WHOLE) | (SHARE[1] * same >= SHARE[0] * (n[at] + n[j] - same))]


def _across(cells: np.ndarray, node: np.ndarray, n: np.ndarray, root: np.ndarray, sketch: np.ndarray) -> list[np.ndarray]:
    """Pairs in a cell between components, each row outside the cell's largest component with all other rows: those whose
    sketches agree in LEAST_FINE bytes and whose shingles may suffice, each pair in the first cell that it shares."""
    edge = _bounds(cells)
    found = [[np.zeros(0, np.int64)] * 2]
    for i in range(len(edge) - 1):
        own = slice(edge[i], edge[i + 1])
        nodes, sizes, roots = node[own], n[own], root[own]
        _, of, counts = np.unique(roots, return_inverse=True, return_counts=True)
        small = of != counts.argmax()
        if not small.any():
            continue
        sketches = sketch[own]
        raw = np.frombuffer(b"".join(x[: FINE + 4 * BANDS] for x in sketches), np.uint8).reshape(len(nodes), -1)
        fine, bands = raw[:, :FINE], np.ascontiguousarray(raw[:, FINE:]).view(np.uint32)
        cell = np.int64(cells[edge[i]]).astype(np.uint64).astype(np.uint32)
        for j in np.flatnonzero(small).tolist():
            ok = (roots != roots[j]) & _close(sizes, sizes[j])
            ok[:j] &= ~small[:j]  # a pair of two such rows comes once
            at = np.flatnonzero(ok)
            at = at[(fine[at] == fine[j]).sum(1) >= LEAST_FINE]
            shared = bands[at] == bands[j]
            at = at[bands[at, shared.argmax(1)] == cell] if len(at) else at
            at = _may_link(sizes, sketches, j, at)
            found.append(_ordered(nodes[at], np.full(len(at), nodes[j])))
    return [np.concatenate(x) for x in zip(*found)]


def _ordered(a: np.ndarray, b: np.ndarray) -> list[np.ndarray]:
    return [np.minimum(a, b), np.maximum(a, b)]


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64), pa.int64())


def _finely(sets: DataFrame, make: Callable) -> DataFrame:
    """node, sketch of the sets (node, shingles)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in row_blocks((8 * np.diff(batch.column(1).offsets.to_numpy())).tolist(), BLOCK_BYTES):
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), *make(batch.column(1).slice(a, b - a)).values()], ["node", "sketch"])
            release()

    return sets.select("node", "shingles").mapInArrow(run, "node bigint, sketch binary")


def near_copies(docs: DataFrame, key: str = "doc_id", text: str = "text", words_each: int = WORDS_EACH) -> DataFrame:
    """Of each (key, text) that occurs: key, text_hash (XXH64 of the text), times (rows), component_id, first.

    component_id is the smallest key reachable by links, its own included (null if none has a key). first: whether these
    are the first rows of their component, by key (a null key last) and text_hash.
    """
    keyed = docs.select(F.col(quoted(key)).alias("key"), F.col(quoted(text)).cast("string").alias("text"))
    name = F.struct(F.col("key").isNull().alias("none"), "key", "hash").alias("name")
    hashed = keyed.select("key", F.xxhash64("text").alias("hash"), "text")

    def sketched(column: pa.Array) -> dict[str, pa.Array]:
        hashes, ends = shingle_sets(column, words_each)
        node, cells = _sketch(hashes, ends)
        sizes = np.diff(ends)
        cells = cells[sizes > 0]
        places = np.concatenate([[0], np.cumsum((sizes > 0) * BANDS)]).astype(np.int32)
        return {"node": _signed(node), "fp": _signed(_fingerprint(hashes, ends)), "n": pa.array(sizes, pa.int64()), "cells": pa.ListArray.from_arrays(pa.array(places), _signed(cells.ravel()))}

    def sets_of(column: pa.Array) -> dict[str, pa.Array]:
        hashes, ends = shingle_sets(column, words_each)
        return {"own": _signed(_set_hash(hashes, ends)), "shingles": pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), _signed(hashes))}

    rows = checkpointed(_mapped(hashed, sketched, "node bigint, fp bigint, n bigint, cells array<bigint>"))
    nodes = rows.groupBy("node").agg(F.min(name).alias("least"), F.first("fp").alias("fp"), F.first("n").alias("n"), F.first("cells").alias("cells"))
    cells = nodes.select("node", "n", F.explode("cells").alias("cell"))
    shared = checkpointed(_by_cell(cells, ["node", "n"], _shared, "cell bigint, node bigint, n bigint"))

    of_print = checkpointed(nodes.groupBy("fp").agg(F.min("node").alias("node")))
    alike = simhash.links(of_print.select("fp")).join(of_print.toDF("a", "x"), "a").join(of_print.toDF("b", "y"), "b").select("x", "y")
    alike = alike.union(nodes.select("fp", "node").join(of_print.toDF("fp", "x"), "fp").filter("node <> x").select("x", "node"))
    first = _by_cell(shared, ["node", "n"], _linear, "a bigint, b bigint").union(alike.select(F.least("x", "y"), F.greatest("x", "y")))
    first = checkpointed(first.distinct())

    wanted = shared.select("node").union(first.select("a")).union(first.select("b")).distinct().join(nodes.select("node", "least"), "node")
    wanted = checkpointed(_known(wanted.select(F.col("least.key").alias("key"), F.col("least.hash").alias("hash"))).select("id", "hash"))
    texts = _known(hashed).filter(maybe_among(wanted, "id", "hash")).join(wanted, ["id", "hash"])
    sets = checkpointed(_mapped(texts, sets_of, "own bigint, shingles array<bigint>").select(F.col("own").alias("node"), "shingles").dropDuplicates(["node"]))

    def verified(pairs: DataFrame) -> DataFrame:
        both = pairs.join(sets.toDF("a", "s"), "a").join(sets.toDF("b", "t"), "b").withColumn("same", F.size(F.array_intersect("s", "t")))
        return both.filter(F.col("same") * SHARE[1] >= (F.size("s") + F.size("t") - F.col("same")) * SHARE[0]).select("a", "b")

    def open_cells(links: DataFrame) -> DataFrame:
        """The rows of cells in which the links so far leave several components, with their roots."""
        rooted = shared.join(components(links).toDF("node", "root"), "node", "left").withColumn("root", F.coalesce("root", "node"))
        apart = rooted.groupBy("cell").agg((F.min("root") != F.max("root")).alias("apart")).filter("apart").select("cell")
        return checkpointed(rooted.join(apart, "cell", "left_semi"))

    def fine_of(column: pa.Array) -> dict[str, pa.Array]:
        ends = column.offsets.to_numpy().astype(np.int64)
        hashes = column.flatten().to_numpy(zero_copy_only=False).view(np.uint64)
        return {"sketch": pa.array(_fine_sketch(hashes, ends - ends[0]), pa.binary())}

    links = checkpointed(verified(first))
    ends = links.select(F.col("a").alias("node")).union(links.select("b"))
    linked = open_cells(links).join(ends.groupBy("node").agg(F.count(F.lit(1)).alias("degree")), "node", "left").fillna(0, ["degree"])
    hubs = checkpointed(_by_cell(linked, ["node", "n", "root", "degree"], _to_hubs, "a bigint, b bigint").distinct().join(first, ["a", "b"], "left_anti"))
    links = checkpointed(links.union(verified(hubs)))
    left = open_cells(links)
    fine = _finely(sets.join(left.select("node").distinct(), "node"), fine_of)
    second = _by_cell(left.join(fine, "node"), ["node", "n", "root", "sketch"], _across, "a bigint, b bigint").join(first.union(hubs), ["a", "b"], "left_anti")
    roots = checkpointed(components(links.union(verified(checkpointed(second)))))
    parted = rows.groupBy("key", "hash", "node").agg(F.count(F.lit(1)).alias("times"))
    least = parted.groupBy("node").agg(F.min(name).alias("least"), F.count(F.lit(1)).alias("n"))
    ids = least.join(roots, "node").groupBy("root").agg(F.min("least").alias("first"), F.count(F.lit(1)).alias("n"))
    n_roots = roots.count()
    of_node = least.join(joined_hot(roots, ids, "root", n_roots, "n").select("node", "first"), "node", "left")
    of_node = checkpointed(of_node.select("node", F.coalesce("first", "least").alias("first"), "n"))
    done = joined_hot(parted, of_node, "node", rows.count(), "n").withColumn("own", name)
    return done.select(F.col("key").alias(key), F.col("hash").alias("text_hash"), "times", F.col("first.key").alias("component_id"), F.col("own").eqNullSafe(F.col("first")).alias("first"))


def one_of_each(docs: DataFrame, key: str = "doc_id", text: str = "text", words_each: int = WORDS_EACH) -> DataFrame:
    """docs with one row of each component, the first by key (a null key last) and by the text's hash; of equal rows of it one stays.

    Identity is the pair of key and text, so that rows which repeat a key with another text are texts of their own. Most
    rows surely stay, and aren't shuffled.
    """
    found = near_copies(docs, key, text, words_each).withColumnRenamed(key, "key").withColumnRenamed("text_hash", "hash")
    found = checkpointed(_known(found.filter("not first or times > 1")).select("id", "hash", "first"))
    marked = docs.select(F.struct(F.col(quoted(key)).alias("key"), F.xxhash64(F.col(quoted(text)).cast("string")).alias("hash"), row_of(docs)).alias("x")).select("x.key", "x.hash", "x.row")
    marked = _known(marked).withColumn("maybe", F.coalesce(maybe_among(found, "id", "hash"), F.lit(False)))
    sure = marked.filter(~F.col("maybe")).select("row.*")
    gone = found.filter(~F.col("first")).select("id", "hash")
    others = marked.filter("maybe").dropDuplicates(["id", "hash"]).join(gone, ["id", "hash"], "left_anti")  # one shuffle
    return sure.union(others.select("row.*"))


def _known(rows: DataFrame) -> DataFrame:
    """rows with a number ``id`` of key and hash, which is never null and makes one identity with the hash."""
    return rows.withColumn("id", F.xxhash64("key", "hash"))
