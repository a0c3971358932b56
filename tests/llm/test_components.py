"""Few edges are joined by one task; loose copies are told apart in their cell, and no link is lost."""

import numpy as np

from askmine.llm import components, shingle_sets


def test_few_edges_take_few_jobs(spark):
    chain = [(i, i + 1) for i in range(1, 400)] + [(1000, i) for i in range(1001, 1200)] + [(-5, 2000), (2000, -7), (3, 3), (None, 8)]
    edges = spark.createDataFrame(chain, "a long, b long").repartition(7)
    expected = {r["node"]: r["root"] for r in components.components(edges, one_task=0).collect()}
    spark.sparkContext.setJobGroup("few edges", "")
    found = components.components(edges).collect()
    jobs = spark.sparkContext.statusTracker().getJobIdsForGroup("few edges")
    spark.sparkContext.setJobGroup("others", "")
    assert {r["node"]: r["root"] for r in found} == expected and len(found) == len(expected) == 603
    assert expected[400] == 1 and expected[1199] == 1000 and expected[2000] == -7
    assert len(jobs) <= 12


def test_other_nodes_go_by_rounds(spark):
    edges = spark.createDataFrame([("b", "a"), ("b", "c"), ("x", "y")], "a string, b string")
    assert {r["node"]: r["root"] for r in components.components(edges).collect()} == {"a": "a", "b": "a", "c": "a", "x": "x", "y": "x"}


def test_loose_copies_give_no_candidates():
    rng = np.random.default_rng(5)
    some = lambda k: rng.integers(0, 1 << 63, k, np.uint64)
    common = some(200)
    sets = [np.concatenate([common, some(39)]) for _ in range(100)]  # any two share 200 of 278
    sets.append(np.concatenate([sets[0][:-5], some(5)]))
    large = some(shingle_sets.WHOLE + 500)
    sets += [large, np.concatenate([large[:-60], some(60)]), large[: shingle_sets.WHOLE + 300]]
    sets = [np.unique(x) for x in sets]
    ends = np.concatenate([[0], np.cumsum([len(x) for x in sets])])
    hashes, n = np.concatenate(sets), np.diff(ends)
    sketch = np.array([*shingle_sets._fine_sketch(hashes, ends), None], object)[:-1]
    cells = shingle_sets._sketch(hashes, ends)[1].view(np.int64).ravel()
    node = np.repeat(np.arange(len(sets)), shingle_sets.BANDS)
    order = np.lexsort((node, n[node], cells))
    cells, node = cells[order], node[order]
    a, b = shingle_sets._across(cells, node, n[node], node, sketch[node])
    linked = {(i, j) for i in range(len(sets)) for j in range(i + 1, len(sets)) if 5 * len(x := np.intersect1d(sets[i], sets[j])) >= 4 * (n[i] + n[j] - len(x))}
    assert linked == {(0, 100), (101, 102), (101, 103), (102, 103)}
    assert set(zip(a.tolist(), b.tolist())) == linked
