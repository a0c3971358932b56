"""The distributed hierarchy against a plain one, over several leaves and levels, and the sweep on it."""

import numpy as np
import pytest

from askmine.operators import density, hierarchy
from tests.plain_density import _core, hdbscan, spanning_tree


def blobs(n=900, seed=5, width=3):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(6, width)) * 4
    sizes = np.array([0.3, 0.2, 0.2, 0.1, 0.05, 0.05])
    return np.concatenate([c + rng.uniform(0.1, 0.6) * rng.normal(size=(int(n * s), width)) for c, s in zip(centres, sizes)] + [rng.uniform(-9, 9, size=(n - sum(int(n * s) for s in sizes), width))])


def frame(spark, points):
    return spark.createDataFrame([(i, p.tolist()) for i, p in enumerate(points)], "id long, point array<double>").repartition(3)


def same_groups(a, b):
    """Whether two labellings are one up to the labels' names; noise is noise in both."""
    pairs = {(x, y) for x, y in zip(a.tolist(), b.tolist())}
    return all((x < 0) == (y < 0) for x, y in pairs) and len(pairs) == len({x for x, _ in pairs}) == len({y for _, y in pairs})


@pytest.mark.parametrize("leaf, level", [(2000, 1 << 18), (100, 1 << 18), (100, 300)])
def test_labels_are_those_of_the_plain_hierarchy(spark, leaf, level):
    points = blobs()
    n = len(points)
    cored = hierarchy.with_cores(hierarchy.packed_leaves(frame(spark, points), n, 3, leaf), 3, 10)
    near = {int(i): d for r in cored.collect() for i, d in zip(np.frombuffer(r["ids"], "<i8"), np.frombuffer(r["near"], "<f8").reshape(-1, 10))}
    assert len(near) == n
    for k in (5, 10):
        core = _core(points, points, k)
        assert np.allclose([near[i][k - 1] for i in range(n)], core, rtol=1e-12)
        found = hierarchy.edges(cored, 3, 10, k)
        for size, method in ((15, "eom"), (15, "leaf"), (40, "eom")):
            fallen, clusters = hierarchy.merged(found, size, level)
            got = {r["id"]: (r["raw"], r["strength"]) for r in hierarchy.labelled(fallen, clusters, method).collect()}
            assert len(got) == n
            labels, strength = hdbscan(points, size, k, method)
            assert labels.max() >= 3 and same_groups(np.array([got[i][0] for i in range(n)]), labels)
            assert np.allclose([got[i][1] for i in range(n)], np.where(labels >= 0, strength, 0))


def test_edges_hold_a_least_spanning_tree(spark):
    points = blobs(500, 8, 2)
    cored = hierarchy.with_cores(hierarchy.packed_leaves(frame(spark, points), 500, 2, 64), 2, 5)
    rows = hierarchy.edges(cored, 2, 5, 5).collect()
    root, total = list(range(500)), 0.0

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for w, a, b in sorted(map(tuple, rows)):
        if find(a) != find(b):
            root[find(a)], total = find(b), total + w
    assert len({find(x) for x in range(500)}) == 1 and len(rows) < 5 * 500
    assert total == pytest.approx(sum(w for w, _, _ in spanning_tree(points, _core(points, points, 5))))


def test_few_equal_and_no_points(spark):
    few = lambda rows: sorted((r["id"], r["cluster"], r["probability"]) for r in density.clustered(spark.createDataFrame(rows, "id long, v array<double>"), "id", "v", min_size=3).collect())
    assert few([]) == [] and few([(1, [1.0, 0.0])]) == [(1, -1, 0.0)]
    assert few([(i, [1.0, 0.0]) for i in range(50)]) == [(i, -1, 0.0) for i in range(50)]
    assert {c for _, c, _ in few([(i, [1.0, i / 10]) for i in range(8)])} == {-1}  # the whole is no cluster


def test_sweep_is_that_of_single_runs(spark):
    points = blobs(400, 3, 4)
    rows = [(i, p.tolist()) for i, p in enumerate(points)] + [(1000 + i, points[0].tolist()) for i in range(100)]
    df = spark.createDataFrame(rows, "id long, v array<double>")
    settings = [("eom", 10, None), ("leaf", 10, 5), ("eom", 25, 5)]
    got = {(r["method"], r["size"], r["samples"]): (r["clusters"], round(r["noise"], 6), round(r["largest"], 6)) for r in density.sweep(df, "id", "v", settings=settings).collect()}
    for method, size, samples in settings:
        labels = np.array([r["cluster"] for r in density.clustered(df, "id", "v", size, samples, method).collect()])
        sizes = np.bincount(labels[labels >= 0])
        assert got[method, size, samples] == (len(sizes), round(100 * (labels < 0).mean(), 6), round(100 * sizes.max() / len(labels), 6))
    assert len(density.SWEEP) == 16


@pytest.mark.parametrize("kind", ["blobs", "grid"])
def test_edges_of_many_leaves_are_one_tree(spark, kind):
    points = blobs(900, 6) if kind == "blobs" else np.stack(np.meshgrid(range(10), range(10), range(8)), -1).reshape(-1, 3).astype(float)  # of equal weights
    n = len(points)
    cored = hierarchy.with_cores(hierarchy.packed_leaves(frame(spark, points), n, 3, 64), 3, 10)
    near = {int(i): d for r in cored.collect() for i, d in zip(np.frombuffer(r["ids"], "<i8"), np.frombuffer(r["near"], "<f8").reshape(-1, 10))}
    for k in (5, 10):
        w, a, b = hierarchy.spanning_tree(points, np.array([near[i][k - 1] for i in range(n)]), np.arange(n))
        assert sorted(map(tuple, hierarchy.edges(cored, 3, 10, k).collect())) == sorted(zip(w.tolist(), np.minimum(a, b).tolist(), np.maximum(a, b).tolist()))


def test_few_pairs_are_weighed():
    rng = np.random.default_rng(4)
    points = np.concatenate([c + 0.3 * rng.normal(size=(600, 3)) for c in ([0, 0, 0], [6, 0, 0], [0, 6, 0])] + [rng.uniform(-3, 9, size=(60, 3))])
    core = _core(points, points, 5)
    leaf = (points[:, 0] > np.median(points[:, 0])).astype(int)
    parts, edges = [], []
    for i in (0, 1):
        ids = np.flatnonzero(leaf == i)
        found, tree = hierarchy.grown(points[ids], core[ids], ids)
        assert sorted(np.concatenate([at for at, _ in found])) == list(range(len(ids))) and 1 < len(found) <= hierarchy.PARTS
        parts += [(i, ids[at], height) for at, height in found]
        edges.append(tree)
    roots = np.array([ids[0] for _, ids, _ in parts])
    links = hierarchy.linked(points[roots], core[roots], {(i, j): hierarchy.passage(points[a], h, points[b], g) for i, (_, a, h) in enumerate(parts) for j, (_, b, g) in enumerate(parts) if i < j})
    n_within = sum(len(w) for w, _, _ in edges)
    for i, (of, a, h) in enumerate(parts):
        for j, (other, b, g) in enumerate(parts):
            if of < other:
                edges += [(w, np.minimum(a[x], b[y]), np.maximum(a[x], b[y])) for w, x, y in hierarchy.between(points[a], core[a], h, points[b], core[b], g, hierarchy.way(i, j, *links))]
    w, a, b = (np.concatenate(c) for c in zip(*edges))
    kept = hierarchy.forest(w, a, b)
    x, y, z = hierarchy.spanning_tree(points, core, np.arange(len(points)))
    assert sorted(zip(w[kept], a[kept], b[kept])) == sorted(zip(x, np.minimum(y, z), np.maximum(y, z)))
    assert len(w) - n_within < 0.1 * (leaf == 0).sum() * (leaf == 1).sum()
