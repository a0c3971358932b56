"""HDBSCAN over any number of points: candidate edges by pairs of leaves, merges level by level, clusters by aggregates.

1. Leaves. Points are dealt to leaves of about LEAF points by the medians of a bounded sample, MOST_LEAVES at most.
2. Core distances. A leaf's own points bound the distance to the k-th nearest; only points whose bound reaches into the box
   of another leaf visit it. So the distances are exact.
3. Edges. A least spanning tree's edge between two leaves lies in the least spanning tree of those two alone, so each pair of
   leaves gives the edges between them; a leaf's own tree gives those within. Bounds from these trees and from passages between
   near leaves leave out most pairs of points, exactly. Pairs go by tiles, whose edges are cut to forests before they are kept.
4. Merges. The edges are dealt to levels by weight, of LEVEL edges at most, about. A level is one task that joins components
   as Kruskal's algorithm does; between levels points learn their component by joins. A component of fewer than the least
   size carries its points, and hands them out when it falls to a larger one or becomes a cluster; so the result is two
   tables: ``fallen`` (a row a point: the cluster it left or was born in, and at which density) and ``clusters`` (a row per
   cluster: its parent, and where it splits off).
5. Clusters are chosen from sums per cluster. Only those reach the driver: a row a cluster, 2 n / least size at most.

All ties are broken by the ends of an edge, so results don't depend on partitions. Points must be distinct and of one width.
An empty table, or fewer points than the least size, has no cluster.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from askmine.operators.dedupe import cut

#: Points of a leaf of few and of many points, leaves and points of the sample at most; edges of a level.
LEAF, LARGE_LEAF, MOST_LEAVES, SAMPLE, LEVEL = 1024, 4096, 4096, 1 << 18, 1 << 18
MOST_TASKS = 4096
#: Edges of the last forests that one task joins once more, at most; with more they stay as they are.
JOINED = 1 << 21
#: Leaves, then tiles, of a side of a tile; and tiles of a side from which forests are joined no further.
TILE, MOST_SIDE = 4, 4
#: Parts to which a part's passages are known and points of a side of one; pairs of points weighed at once; what rounding may do.
NEIGHBOURS, PASSAGE, BLOCK, SLACK = 12, 512, 1 << 20, 1e-9
#: Parts of a leaf at most, points of a part at least.
PARTS, PART = 8, 16
PACKED = "leaf int, ids binary, xs binary"
EDGE = "w double, a bigint, b bigint"


def _floats(data: bytes, width: int) -> np.ndarray:
    return np.frombuffer(data, "<f8").reshape(-1, width)


def _ids(data: bytes) -> np.ndarray:
    return np.frombuffer(data, "<i8")


def distances(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Distances of each x to each y; one dimension after the other, so that a pair has the same one wherever it is met."""
    out = np.zeros((len(x), len(y)))
    for k in range(x.shape[1]):
        out += (x[:, k, None] - y[None, :, k]) ** 2
    return np.sqrt(out, out=out)


def medians(sample: np.ndarray, n_leaves: int) -> tuple[np.ndarray, np.ndarray]:
    """Dimension and threshold of the nodes of a full tree of n_leaves (a power of two), each by its widest dimension's median."""
    dims, cuts = np.zeros(n_leaves, int), np.zeros(n_leaves)
    own = {1: sample}
    for node in range(1, n_leaves):
        points = own.pop(node)
        if len(points):
            dims[node] = np.argmax(points.max(0) - points.min(0))
            cuts[node] = np.median(points[:, dims[node]])
        left = points[:, dims[node]] < cuts[node]
        own[2 * node], own[2 * node + 1] = points[left], points[~left]
    return dims, cuts


def packed_leaves(points: DataFrame, n: int, width: int, leaf: int | None = None) -> DataFrame:
    """leaf, ids, xs: a row per leaf; points: id (bigint), point (array of doubles)."""
    n_leaves = 1
    leaf = leaf or max(LEAF, min(LARGE_LEAF, n // 64))
    while n_leaves * leaf < n and n_leaves < MOST_LEAVES:
        n_leaves *= 2
    some = points if n <= SAMPLE else points.filter(F.pmod(F.xxhash64("id", F.lit(7)), F.lit(n)) < F.lit(SAMPLE))
    sample = np.array([r["point"] for r in some.select("point").collect()], float).reshape(-1, width) if n_leaves > 1 else np.zeros((0, width))
    dims, cuts = medians(sample, n_leaves)

    def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, width)
            node = np.ones(len(x), int)
            while len(node) and node[0] < n_leaves:
                node = 2 * node + (x[np.arange(len(x)), dims[node]] >= cuts[node])
            yield pa.RecordBatch.from_arrays([pa.array(node - n_leaves, pa.int32()), batch.column(0), batch.column(1)], ["leaf", "id", "point"])

    def pack(table: pa.Table) -> pa.Table:
        ids = table.column("id").to_numpy()
        order = np.argsort(ids)
        x = table.column("point").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, width)
        return pa.table([table.column("leaf")[:1].cast(pa.int32()), pa.array([ids[order].astype("<i8").tobytes()]), pa.array([x[order].astype("<f8").tobytes()])], ["leaf", "ids", "xs"])

    rows = points.select("id", F.col("point").cast("array<double>").alias("point")).mapInArrow(dealt, "leaf int, id bigint, point array<double>")
    return cut(rows.groupBy("leaf").applyInArrow(pack, PACKED).repartition(min(n_leaves, 1024), "leaf"))


def _nearest(x: np.ndarray, y: np.ndarray, k: int) -> np.ndarray:
    """The k least distances of each x to the ys, in order; infinite where there are fewer."""
    out = np.full((len(x), k), np.inf)
    for a in range(0, len(x), 512):
        d = distances(x[a : a + 512], y)
        d = np.partition(d, k - 1, axis=1)[:, :k] if d.shape[1] > k else d
        out[a : a + 512, : d.shape[1]] = np.sort(d, axis=1)
    return out


def with_cores(leaves: DataFrame, width: int, k: int) -> DataFrame:
    """leaves with near: for each point its distances to the k nearest points, itself among them, as a binary of doubles."""

    def bounds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            xs = [_floats(x, width) for x in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([x.min(0).tolist() for x in xs], pa.list_(pa.float64())), pa.array([x.max(0).tolist() for x in xs], pa.list_(pa.float64()))], ["leaf", "low", "high"])

    boxes = leaves.mapInArrow(bounds, "leaf int, low array<double>, high array<double>").collect()  # MOST_LEAVES rows at most
    names = np.array([r["leaf"] for r in boxes])
    low, high = (np.array([r[c] for r in boxes], float).reshape(-1, width) for c in ("low", "high"))

    def own_and_visits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for leaf, ids, xs in zip(*(c.to_pylist() for c in batch.columns)):
                x = _floats(xs, width)
                near = _nearest(x, x, k)
                rows = [(leaf, leaf, ids, b"", near.astype("<f8").tobytes())]
                for i in np.flatnonzero(names != leaf):
                    outside = np.maximum(0, np.maximum(low[i] - x, x - high[i]))
                    go = np.sqrt((outside**2).sum(1)) <= near[:, -1]
                    if go.any():
                        rows.append((int(names[i]), leaf, _ids(ids)[go].tobytes(), x[go].tobytes(), b""))
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), (pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.binary()))], ["leaf", "home", "ids", "visitors", "near"])

    def visit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for home, ids, visitors, xs in zip(*(c.to_pylist() for c in batch.columns)):
                near = _nearest(_floats(visitors, width), _floats(xs, width), k)
                yield pa.RecordBatch.from_arrays([pa.array([home], pa.int32()), pa.array([ids]), pa.array([near.astype("<f8").tobytes()])], ["leaf", "ids", "near"])

    def merged(table: pa.Table) -> pa.Table:
        parts = [(_ids(i), _floats(d, k)) for i, d in zip(table.column("ids").to_pylist(), table.column("near").to_pylist())]
        ids, at = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
        best, start = np.full((len(ids), k), np.inf), 0
        for own, near in parts:
            place = at[start : start + len(own)]
            best[place] = np.sort(np.concatenate([best[place], near], axis=1), axis=1)[:, :k]
            start += len(own)
        return pa.table([table.column("leaf")[:1], pa.array([best.astype("<f8").tobytes()])], ["leaf", "near"])

    found = cut(leaves.mapInArrow(own_and_visits, "leaf int, home int, ids binary, visitors binary, near binary"))
    visits = found.filter("near = X''").join(leaves.select("leaf", "xs"), "leaf").select("home", "ids", "visitors", "xs")
    near = found.filter("near <> X''").select("leaf", "ids", "near").unionByName(visits.mapInArrow(visit, "leaf int, ids binary, near binary"))
    return cut(leaves.join(near.groupBy("leaf").applyInArrow(merged, "leaf int, near binary"), "leaf"))


def spanning_tree(x: np.ndarray, core: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(weights, from, to) of a least spanning tree under mutual reachability, by places; ties by the smaller, then the larger id."""
    n = len(x)
    weight, parent, open_ = np.full(n, np.inf), np.zeros(n, int), np.ones(n, bool)
    low, high = np.full(n, np.iinfo(np.int64).max), np.full(n, np.iinfo(np.int64).max)
    out_w, out_a, out_b = np.zeros(max(0, n - 1)), np.zeros(max(0, n - 1), int), np.zeros(max(0, n - 1), int)
    now = 0
    columns = [np.ascontiguousarray(x[:, k]) for k in range(x.shape[1])]
    for i in range(n - 1):
        open_[now] = False
        d = np.zeros(n)
        for c in columns:
            d += (c - c[now]) ** 2
        d = np.maximum(np.maximum(np.sqrt(d), core), core[now])
        closer = np.flatnonzero(open_ & (d <= weight))
        a, b = np.minimum(ids[closer], ids[now]), np.maximum(ids[closer], ids[now])
        better = (d[closer] < weight[closer]) | (a < low[closer]) | ((a == low[closer]) & (b < high[closer]))
        closer = closer[better]
        weight[closer], parent[closer], low[closer], high[closer] = d[closer], now, a[better], b[better]
        least = np.where(open_, weight, np.inf)
        ties = np.flatnonzero(open_ & (least == least.min()))
        now = int(ties[np.lexsort((high[ties], low[ties]))[0]]) if len(ties) > 1 else int(ties[0])
        out_w[i], out_a[i], out_b[i] = weight[now], parent[now], now
    return out_w, out_a, out_b


def forest(w: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Places of the edges of the least spanning forest, in order of weight; ties by a, then by b. Equal edges count once."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    order = np.lexsort((b, a, w))
    root = list(range(len(nodes)))

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    kept = []
    for i, x, y in zip(order.tolist(), at[: len(a)][order].tolist(), at[len(a) :][order].tolist()):
        x, y = find(x), find(y)
        if x != y:
            root[x] = y
            kept.append(i)
    return np.array(kept, int)


def _in_forests(table: pa.Table) -> pa.Table:
    """A group's edges that are in its forest."""
    table = table.select(["w", "a", "b", "p", "q"])
    return table.take(pa.array(forest(*(table.column(c).to_numpy() for c in ("w", "a", "b")))))


def heights(x: np.ndarray, core: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Each point's height: the greatest weight on its way to the first point in a least spanning tree; and the tree."""
    w, a, b = spanning_tree(x, core, ids)
    out = np.zeros(len(x))
    for weight, up, down in zip(w.tolist(), a.tolist(), b.tolist()):  # from the first point on
        out[down] = max(out[up], weight)
    return np.maximum(out, core), w, a, b


def parted(n: int, w: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The part of each point: a tree from its first point on is cut at the heaviest edges that leave PART points on both sides."""
    size = [1] * n
    for up, down in zip(reversed(a.tolist()), reversed(b.tolist())):
        size[up] += size[down]
    below = np.array(size)[b]
    fit = np.flatnonzero((below >= PART) & (n - below >= PART))
    cuts = set(fit[np.argsort(-w[fit], kind="stable")][: PARTS - 1].tolist())
    part, new = [0] * n, 0
    for i, (up, down) in enumerate(zip(a.tolist(), b.tolist())):
        if i in cuts:
            new += 1
        part[down] = new if i in cuts else part[up]
    return np.array(part, int)


def grown(x: np.ndarray, core: np.ndarray, ids: np.ndarray) -> tuple[list[tuple[np.ndarray, np.ndarray]], tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(places, heights) of a leaf's parts, each from its densest point on, the first of the places; and the leaf's own edges."""
    _, w, a, b = heights(x, core, ids)
    part = parted(len(x), w, a, b)
    out = []
    for i in range(part.max() + 1):
        own = np.flatnonzero(part == i)
        own = own[np.lexsort((ids[own], core[own]))]
        out.append((own, heights(x[own], core[own], ids[own])[0]))
    return out, (w, np.minimum(ids[a], ids[b]), np.maximum(ids[a], ids[b]))


def _outside(x: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """The distance of each x to a box."""
    return np.sqrt((np.maximum(0, np.maximum(low - x, x - high)) ** 2).sum(1))


def passage(x: np.ndarray, height: np.ndarray, y: np.ndarray, other: np.ndarray) -> float:
    """A weight that suffices to come from one part's root to the other's: by one edge between the PASSAGE points that are best placed."""
    some = np.argsort(np.maximum(height, _outside(x, y.min(0), y.max(0))), kind="stable")[:PASSAGE]
    more = np.argsort(np.maximum(other, _outside(y, x.min(0), x.max(0))), kind="stable")[:PASSAGE]
    return float(np.maximum(np.maximum(height[some][:, None], other[more]), distances(x[some], y[more])).min())


def linked(points: np.ndarray, cores: np.ndarray, known: dict[tuple[int, int], float]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(up, weight, turn) of each part in a least spanning tree of the roots: by their own edges, or by a known passage that is less."""
    n = len(points)
    lower: dict[int, list] = defaultdict(list)
    for (i, j), w in known.items():
        lower[i].append((j, w))
        lower[j].append((i, w))
    up, weight, turn, open_ = np.zeros(n, int), np.full(n, np.inf), np.zeros(n, int), np.ones(n, bool)
    now = 0
    for i in range(n):
        turn[now], open_[now] = i, False
        d = np.maximum(np.maximum(distances(points[now : now + 1], points)[0], cores), cores[now])
        for j, w in lower[now]:
            d[j] = min(d[j], w)
        less = open_ & (d < weight)
        weight[less], up[less] = d[less], now
        now = int(np.argmin(np.where(open_, weight, np.inf)))
    return up, weight, turn


def way(i: int, j: int, up: np.ndarray, weight: np.ndarray, turn: np.ndarray) -> float:
    """The greatest weight on the way between two parts' roots."""
    most = 0.0
    while i != j:
        if turn[i] < turn[j]:
            i, j = j, i
        most, i = max(most, weight[i]), up[i]
    return float(most)


def between(x: np.ndarray, core: np.ndarray, height: np.ndarray, y: np.ndarray, other_core: np.ndarray, other: np.ndarray, most: float) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(weights, places in x, places in y) of the edges between parts of two leaves that may be in a least spanning tree, by blocks.

    Two points are joined by way of the roots at the greatest of their heights and ``most``; an edge above that closes a cycle
    of lesser ones. Points whose own bound doesn't reach the other's box meet only those whose bound reaches theirs.
    """
    a, b = np.maximum(height, most), np.maximum(other, most)
    inside = _outside(x, y.min(0), y.max(0)) <= a * (1 + SLACK)
    others = np.flatnonzero(_outside(y, x.min(0), x.max(0)) <= b * (1 + SLACK))
    middle = (x.min(0) + x.max(0)) / 2
    p, q = x - middle, y - middle
    pp, qq = (p**2).sum(1), (q**2).sum(1)
    error = 1e-3 * SLACK * (pp.max() + qq.max())
    for rows, columns in ((np.flatnonzero(inside), np.arange(len(y))), (np.flatnonzero(~inside), others)):
        if not len(rows) or not len(columns):
            continue
        step = max(1, BLOCK // len(columns))
        for own in (rows[i : i + step] for i in range(0, len(rows), step)):
            bound = np.maximum(a[own][:, None], b[columns])
            i, j = np.nonzero(pp[own][:, None] + qq[columns] - 2 * (p[own] @ q[columns].T) <= bound**2 * (1 + SLACK) + error)
            within, i, j = bound[i, j], own[i], columns[j]
            d = np.zeros(len(i))
            for c in range(x.shape[1]):
                d += (x[i, c] - y[j, c]) ** 2
            w = np.maximum(np.maximum(np.sqrt(d), core[i]), other_core[j])
            few = w <= within
            yield w[few], i[few], j[few]


def _lightest(parts: list[tuple]) -> list[tuple]:
    """The least spanning forest of edges in parts, as one part."""
    w, a, b = (np.concatenate(c) for c in zip(*parts))
    at = forest(w, a, b)
    return [(w[at], a[at], b[at])]


def edges(cored: DataFrame, width: int, k: int, of: int) -> DataFrame:
    """w, a, b (a < b): edges that hold a least spanning tree; the core distance is that to the of-th of the k nearest.

    Each leaf has its own least spanning tree, cut into parts, and passages to the NEIGHBOURS nearest parts bound how two roots
    are joined; so most edges between leaves are known to close a cycle before they are weighed (see ``between``). Pairs of
    leaves go by tiles of TILE x TILE leaves, so that a leaf is sent to each tile once, with one core distance a point. An edge
    that closes a cycle among the lesser ones of its tile is in no spanning tree, so a tile gives its forest; the forests of
    TILE x TILE tiles are joined to theirs, and so on to MOST_SIDE tiles a side, and once more where JOINED edges are left at most.
    """
    spark = cored.sparkSession
    columns = ["leaf", "part", "ids", "xs", "core", "height", "tw", "ta", "tb"]
    types = [pa.int32(), pa.int32(), *[pa.binary()] * 7, pa.list_(pa.float64()), pa.float64(), *[pa.list_(pa.float64())] * 2, pa.float64()]

    def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for leaf, ids, xs, near in zip(*(c.to_pylist() for c in batch.columns)):
                x, core, ids = _floats(xs, width), np.ascontiguousarray(_floats(near, k)[:, of - 1]), _ids(ids)
                found, tree = grown(x, core, ids)
                rows = []
                for part, (at, height) in enumerate(found):
                    own = [] if part else tree
                    y = x[at]
                    rows.append([leaf, part, *(c.tobytes() for c in (ids[at], y, core[at], height)), *([c.tobytes() for c in own] or [None] * 3), y[0].tolist(), float(core[at[0]]), y.min(0).tolist(), y.max(0).tolist(), float(height.max())])
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], [*columns, "root", "least", "low", "high", "top"])

    parted_leaves = cut(cored.select("leaf", "ids", "xs", "near").mapInArrow(parts, "leaf int, part int, ids binary, xs binary, core binary, height binary, tw binary, ta binary, tb binary, root array<double>, least double, low array<double>, high array<double>, top double"))
    boxes = sorted(parted_leaves.select("leaf", "part", "root", "least", "low", "high", "top").collect(), key=lambda r: (r["leaf"], r["part"]))  # PARTS x MOST_LEAVES at most
    of_leaf = {name: i for i, name in enumerate(sorted({r["leaf"] for r in boxes}))}
    side = -(-len(of_leaf) // TILE)
    roots, low, high = (np.array([r[c] for r in boxes], float).reshape(-1, width) for c in ("root", "low", "high"))
    top = np.array([r["top"] for r in boxes], float)
    places = spark.createDataFrame([(r["leaf"], r["part"], i, of_leaf[r["leaf"]], of_leaf[r["leaf"]] // TILE) for i, r in enumerate(boxes)], "leaf int, part int, place int, at int, own int")
    slim = parted_leaves.select(*columns).join(F.broadcast(places), ["leaf", "part"])

    pairs = set()
    for i in range(len(boxes)):
        gap = (np.maximum(0, np.maximum(low[i] - high, low - high[i])) ** 2).sum(1)
        close = np.lexsort((((roots - roots[i]) ** 2).sum(1), gap))
        pairs |= {(min(i, j), max(i, j)) for j in close[: NEIGHBOURS + 1].tolist() if i != j}
    known: dict[tuple[int, int], float] = {}
    if pairs:
        wanted = spark.createDataFrame(sorted(pairs | {(i, i) for i, _ in pairs}), "home int, place int")

        def passages(table: pa.Table) -> pa.Table:
            home = table.column("home")[0].as_py()
            met = {place: (_floats(xs, width), np.frombuffer(height, "<f8")) for place, xs, height in zip(*(table.column(c).to_pylist() for c in ("place", "xs", "height")))}
            rows = [(home, place, passage(*met[home], *other)) for place, other in met.items() if place != home]
            return pa.table([pa.array(c, t) for c, t in zip(zip(*rows), (pa.int32(), pa.int32(), pa.float64()))], ["home", "place", "w"])

        sent = slim.select("place", "xs", "height").join(F.broadcast(wanted), "place")
        known = {(r["home"], r["place"]): r["w"] for r in sent.groupBy("home").applyInArrow(passages, "home int, place int, w double").collect()}
    tree = linked(roots, np.array([r["least"] for r in boxes], float), known)

    tiles = slim.withColumn("other", F.explode(F.sequence(F.lit(0), F.lit(max(0, side - 1)))))
    same = F.col("own") == F.col("other")
    tiles = tiles.select("place", "at", "ids", "xs", "core", "height", *[F.when(same, F.col(c)).alias(c) for c in ("tw", "ta", "tb")], F.least("own", "other").alias("p"), F.greatest("own", "other").alias("q"))

    def run(table: pa.Table) -> pa.Table:
        rows = sorted(zip(*(table.column(c).to_pylist() for c in ("place", "at", "ids", "xs", "core", "height", "tw", "ta", "tb"))), key=lambda r: r[0])
        met = [(place, at, _ids(ids), (_floats(xs, width), np.frombuffer(core, "<f8"), np.frombuffer(height, "<f8"))) for place, at, ids, xs, core, height, *_ in rows]
        p, q = table.column("p")[0].as_py(), table.column("q")[0].as_py()
        out = [(np.zeros(0), np.zeros(0, np.int64), np.zeros(0, np.int64))]
        out += [(np.frombuffer(r[6], "<f8"), _ids(r[7]), _ids(r[8])) for r in rows if p == q and r[6] is not None]
        held, seconds = 0, [r for r in met if r[1] // TILE == q]
        others = np.array([r[0] for r in seconds], int)
        for i, at, ids, first in (r for r in met if r[1] // TILE == p):
            gaps = np.sqrt((np.maximum(0, np.maximum(low[i] - high[others], low[others] - high[i])) ** 2).sum(1))
            for (j, other_at, other_ids, second), gap in zip(seconds, gaps.tolist()):
                if other_at <= at:
                    continue
                most = way(i, j, *tree)
                if gap > max(top[i], top[j], most) * (1 + SLACK):
                    continue
                for w, a, b in between(*first, *second, most):
                    a, b = ids[a], other_ids[b]
                    out.append((w, np.minimum(a, b), np.maximum(a, b)))
                    held += len(w)
                    if held > BLOCK:  # so many edges of a tile are kept, and its forest
                        out, held = _lightest(out), 0
        w, a, b = _lightest(out)[0]
        return pa.table([pa.array(w), pa.array(a), pa.array(b), pa.array(np.full(len(w), p), pa.int32()), pa.array(np.full(len(w), q), pa.int32())], ["w", "a", "b", "p", "q"])

    tiled = EDGE + ", p int, q int"
    dealt = tiles.repartition(max(1, min(side * (side + 1) // 2, MOST_TASKS)), "p", "q")
    found = dealt.groupBy("p", "q").applyInArrow(run, tiled)
    while side > MOST_SIDE:
        side = -(-side // TILE)
        found = found.withColumns({c: (F.col(c) / TILE).cast("int") for c in "pq"}).groupBy("p", "q").applyInArrow(_in_forests, tiled)
    found = cut(found)
    if side > 1 and found.count() <= JOINED:
        found = found.withColumns({c: F.lit(0) for c in "pq"}).groupBy("p", "q").applyInArrow(_in_forests, tiled)
    return found.select("w", "a", "b")


class Merging:
    """Components of one level, joined edge by edge; what falls and what splits off is written down."""

    def __init__(self, min_size: int, level: int) -> None:
        self.min_size, self.next = min_size, level << 32
        self.fallen: list[tuple[int, int, float]] = []
        self.clusters: list[tuple[int, int, float, int]] = []

    def run(self, w: np.ndarray, a: np.ndarray, b: np.ndarray, size: list[int], cluster: list[int], members: list[list[int]]) -> list[int]:
        """The root of each component; a, b: places of components, whose size, cluster (-1: none yet) and points (of small ones) change."""
        root = list(range(len(size)))

        def find(x: int) -> int:
            while root[x] != x:
                root[x] = root[root[x]]
                x = root[x]
            return x

        for weight, x, y in zip(w.tolist(), a.tolist(), b.tolist()):
            x, y = find(x), find(y)
            if x == y:
                continue
            if size[x] < size[y]:
                x, y = y, x
            total = size[x] + size[y]
            if cluster[x] >= 0 and cluster[y] >= 0:
                self.clusters += [(cluster[c], self.next, weight, size[c]) for c in (x, y)]
                cluster[x], self.next = self.next, self.next + 1
            elif cluster[x] >= 0:
                self.fallen += [(p, cluster[x], weight) for p in members[y]]
            elif total >= self.min_size:
                cluster[x], self.next = self.next, self.next + 1
                self.fallen += [(p, cluster[x], weight) for p in members[x] + members[y]]
                members[x] = []
            else:
                members[x] = members[x] + members[y]
            members[y] = []
            root[y], size[x] = x, total
        return [find(x) for x in range(len(size))]


EVENTS = "kind string, node bigint, other bigint, w double, size bigint, members array<bigint>"


def _level(min_size: int, level: int):
    """A level's edges, in one task of LEVEL rows or so, to its events: fall, split, and move (a component into another)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b for b in batches if b.num_rows]
        if not held:
            return
        table = pa.Table.from_batches(held)
        w, a, b, na, nb = (table.column(c).to_numpy() for c in ("w", "a", "b", "na", "nb"))
        nodes, at = np.unique(np.concatenate([na, nb]), return_inverse=True)
        size, cluster, members = [1] * len(nodes), [-1] * len(nodes), [[int(x)] for x in nodes]
        for side, own in (("a", at[: len(na)]), ("b", at[len(na) :])):
            known = table.column(f"size_{side}").is_valid().to_numpy()
            first = np.flatnonzero(known)[np.unique(own[known], return_index=True)[1]]
            told = table.select([f"size_{side}", f"cluster_{side}", f"members_{side}"]).take(pa.array(first))
            for i, (s, c, m) in zip(own[first], zip(*(x.to_pylist() for x in told.columns))):
                size[i], cluster[i], members[i] = s, c, m
        order = np.lexsort((b, a, w))
        merging = Merging(min_size, level)
        roots = merging.run(w[order], at[: len(na)][order], at[len(na) :][order], size, cluster, members)
        rows = [("fall", p, c, x, 1, None) for p, c, x in merging.fallen] + [("split", c, p, x, s, None) for c, p, x, s in merging.clusters]
        rows += [("move", int(nodes[i]), int(nodes[r]), float(cluster[r]), size[r], members[r] if i == r else None) for i, r in enumerate(roots)]
        types = [pa.string(), pa.int64(), pa.int64(), pa.float64(), pa.int64(), pa.list_(pa.int64())]
        for start in range(0, len(rows), 1 << 15):
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows[start : start + (1 << 15)]), types)], [x.split()[0] for x in EVENTS.split(", ")])

    return run


def merged(found: DataFrame, min_size: int, level_edges: int = LEVEL) -> tuple[DataFrame, DataFrame]:
    """(fallen: id, cluster, w; clusters: cluster, parent, w, size) of edges that hold a spanning tree.

    A cluster's number is larger than those of its children; the one without a parent is the whole.
    """
    rest = found.select("w", "a", "b", F.col("a").alias("na"), F.col("b").alias("nb"))
    n = rest.count()
    n_levels = max(1, -(-n // level_edges))
    if n_levels == 1:
        rest = rest.withColumn("level", F.lit(0))
    else:
        rest = cut(rest.repartitionByRange(n_levels, "w", "a", "b").withColumn("level", F.spark_partition_id()))
    spark = found.sparkSession
    nodes = spark.createDataFrame([], "node bigint, size bigint, cluster bigint, members array<bigint>")
    state = lambda side: nodes.select(*[F.col(c).alias(f"n{side}" if c == "node" else f"{c}_{side}") for c in nodes.columns])
    events = []
    for level in range(n_levels):
        own = rest.filter(F.col("level") == level)
        if level:
            own = own.join(state("a"), "na", "left").join(state("b"), "nb", "left")
        else:
            nothing = {f"{c}_{side}": F.lit(None).cast(kind) for side in "ab" for c, kind in (("size", "bigint"), ("cluster", "bigint"), ("members", "array<bigint>"))}
            own = own.withColumns(nothing)
        told = cut(own.select("w", "a", "b", "na", "nb", *[f"{c}_{s}" for s in "ab" for c in ("size", "cluster", "members")]).coalesce(1).mapInArrow(_level(min_size, level), EVENTS))
        events.append(told)
        if level + 1 < n_levels:
            moves = told.filter("kind = 'move'").select("node", F.col("other").alias("_to"))
            new = told.filter("kind = 'move' and node = other").select("node", "size", F.col("w").cast("bigint").alias("cluster"), F.coalesce("members", F.array().cast("array<bigint>")).alias("members"))
            nodes = cut(nodes.join(moves, "node", "left_anti").unionByName(new))
            for side in ("na", "nb"):  # twice a level's edges at most
                rest = rest.join(F.broadcast(moves.withColumnRenamed("node", side)), side, "left").withColumn(side, F.coalesce("_to", side)).drop("_to")
            rest = cut(rest.filter((F.col("level") > level) & (F.col("na") != F.col("nb"))).select("w", "a", "b", "na", "nb", "level"))
    every = events[0]
    for more in events[1:]:
        every = every.unionByName(more)
    fallen = every.filter("kind = 'fall'").select(F.col("node").alias("id"), F.col("other").alias("cluster"), "w")
    return fallen, every.filter("kind = 'split'").select(F.col("node").alias("cluster"), F.col("other").alias("parent"), "w", "size")


def selected(fallen: DataFrame, clusters: DataFrame, method: str) -> dict[int, int]:
    """The chosen cluster that each cluster lies in (or is); clusters outside are absent. eom: of most stability, leaf: without children."""
    sums = {r["cluster"]: (r["s"], r["n"]) for r in fallen.groupBy("cluster").agg(F.sum(1 / F.col("w")).alias("s"), F.count(F.lit(1)).alias("n")).collect()}
    rows = clusters.collect()
    parent, born = {r["cluster"]: r["parent"] for r in rows}, {r["cluster"]: 1 / r["w"] for r in rows}
    inner: dict[int, list] = defaultdict(list)
    for r in rows:
        inner[r["parent"]].append(r)
    names = sorted({*sums, *parent, *inner})
    best: dict[int, float] = {}
    chosen: set[int] = set()
    for c in names:  # children come before their parent
        if c not in parent:
            continue  # the whole is no cluster
        at = born[c]
        s, n = sums.get(c, (0.0, 0))
        own = s - at * n + sum(r["size"] * (1 / r["w"] - at) for r in inner[c])
        below = sum(best[r["cluster"]] for r in inner[c])
        if method == "leaf" and inner[c]:
            best[c] = own
        elif method == "leaf" or own >= below or not inner[c]:
            best[c] = own
            chosen.add(c)
        else:
            best[c] = below
    of: dict[int, int] = {}
    for c in reversed(names):  # a chosen cluster takes in those below it
        up = of.get(parent.get(c))
        if up is not None:
            of[c] = up
        elif c in chosen:
            of[c] = c
    return of


def labelled(fallen: DataFrame, clusters: DataFrame, method: str = "eom") -> DataFrame:
    """id, raw (a chosen cluster or -1), strength (0 to 1) of every point that is in ``fallen``."""
    of = selected(fallen, clusters, method)
    known = fallen.sparkSession.createDataFrame(list(of.items()), "cluster bigint, raw bigint")
    named = fallen.join(known, "cluster", "left").select("id", F.coalesce("raw", F.lit(-1)).alias("raw"), (1 / F.col("w")).alias("lam"))
    most = named.filter("raw >= 0").groupBy("raw").agg(F.max("lam").alias("most"))
    return named.join(F.broadcast(most), "raw", "left").select("id", "raw", F.coalesce(F.col("lam") / F.col("most"), F.lit(0.0)).alias("strength"))
