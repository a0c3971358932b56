"""The scoring queries against plain versions on small tables, and the curve's use for pruning."""

import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from askmine.llm import hilbert, quality, queries, toxicity
from askmine.llm.calibrate import calibrated, isotonic

crc = lambda i, of: zlib.crc32(str(i).encode()) % of


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    rng = np.random.default_rng(5)
    syllables = "the ing er on st re an ha ed ou in at".split()
    prose = lambda n: " ".join("".join(rng.choice(syllables, rng.integers(1, 4))) for _ in range(n))
    docs = [prose(int(rng.integers(20, 90))) if i % 3 else " ".join([prose(2), "### $$$"] * int(rng.integers(2, 30))) for i in range(240)]
    docs = [t if i % 5 else t + " you idiot. Such scum, worthless" for i, t in enumerate(docs)] + ["", None, " ", docs[3], "wxoxrxtxhxlxexsxs"]
    path = tmp_path_factory.mktemp("scored")
    spark.createDataFrame([(i, t) for i, t in enumerate(docs)], "doc_id long, text string").repartition(3).write.parquet(str(path / "documents.parquet"))
    labels = [(i, int(i % 3 > 0), int(i % 5 == 0)) for i in range(240)] + [(1, None, None)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(str(path / "labels.parquet"))
    return str(path), docs


def test_quality_query(spark, folder):
    path, docs = folder
    got = {r["doc_id"]: r for r in queries.op9_fourier(spark, path).collect()}
    stats = np.array(quality.statistics(pa.array(docs, pa.string())))
    fourier = quality.Fourier(stats.mean(0), stats.std(0), quality.FEATURES, quality.WIDTH)
    train = [i for i in range(240) if crc(i, 4) != 2]
    z, y = fourier(stats), np.array([i % 3 > 0 for i in range(240)], float)
    weights = np.linalg.solve(z[train].T @ z[train] + quality.RIDGE * np.eye(z.shape[1]), z[train].T @ y[train])
    raw = z @ weights
    place = np.floor(np.clip(raw[train], -0.5, 1.5) * (quality.BINS // 2)).astype(int)
    bins = [(raw[train][place == b].mean(), y[train][place == b].mean(), float((place == b).sum())) for b in np.unique(place)]
    expected = calibrated(raw, isotonic(*map(np.array, zip(*bins))))
    assert len(got) == len(docs)
    for i, r in got.items():
        assert r["score"] == pytest.approx(expected[i], abs=1e-6) and r["held_out"] == (crc(i, 4) == 2) and r["predicted"] == int(r["score"] >= 0.7)


def brute_kernel(s, t):
    """All common subsequences of ORDER letters, one by one."""
    from itertools import combinations

    def weights(x):
        out = {}
        for at in combinations(range(len(x)), toxicity.ORDER):
            key = tuple(x[i] for i in at)
            out[key] = out.get(key, 0.0) + toxicity.DECAY ** (at[-1] - at[0] + 1)
        return out

    a, b = weights(s), weights(t)
    return sum(v * b.get(k, 0.0) for k, v in a.items())


def test_toxicity_query(spark, folder):
    """The query's scores are those of the kernel machine, its kernel, sentences and facts computed letter by letter."""
    path, docs = folder
    got = {r["doc_id"]: r for r in queries.op5_string_kernel(spark, path).collect()}
    train = [i for i in range(240) if crc(i, 3) != 1]
    model = toxicity.Model([docs[i] for i in train], np.array([i % 5 == 0 for i in train]))
    marks = [tuple(w.tolist()) for w in model.landmarks.words]
    assert "idiot" in [toxicity.decoded(np.array(w)) for w in marks] and len(got) == len(docs)
    cache = {}

    def kernels(word):
        if word not in cache:
            code = tuple(toxicity.encoded(word).tolist())
            row = np.zeros(len(marks))
            for j, m in enumerate(marks):
                shared = len(set(m) & set(code)) / len(set(m))
                if toxicity.ORDER <= len(code) <= 2 * len(m) and shared >= toxicity.SHARE:
                    row[j] = brute_kernel(code, m) / np.sqrt(brute_kernel(code, code) * brute_kernel(m, m))
            cache[word] = row
        return cache[word]

    checked = [i for i in (0, 1, 3, 5, 7, 10, 240, 241, 242, 243, 244)]
    for i in checked:
        tokens = (docs[i] or "").split()
        words = ["".join(c for c in w.lower() if c.isalpha()) for w in tokens]
        ends = np.cumsum([0, *(w[-1] in ".!?" and len(x) > 1 for w, x in zip(tokens, words))])[: len(tokens)]
        rows = {}
        for w, s in zip(words, ends):
            if w:
                rows[s] = np.maximum(rows.get(s, 0), kernels(w))
        found = [r for r in rows.values() if r.any()]
        score = np.array([r @ model.weights + model.bias for r in found])
        facts = model._facts(np.array([sum(bool(w) for w in words)]), np.zeros(len(found), int), score)
        expected = calibrated(model._evidence(facts), model.knots)[0]
        assert got[i]["score"] == pytest.approx(expected, abs=2e-3), docs[i]
    assert all(r["held_out"] == (crc(i, 3) == 1) and r["predicted"] == int(r["score"] >= 0.7) for i, r in got.items())
    assert got[240]["score"] == got[241]["score"] == got[242]["score"] < 0.5
    held = [i for i in range(240) if crc(i, 3) == 1]
    assert np.mean([got[i]["predicted"] == (i % 5 == 0) for i in held]) > 0.95


def test_runs_prune(spark):
    """Runs along the curve cover few of the values of each dimension: filters on any of them skip most shards."""
    rng = np.random.default_rng(8)
    rows = [(i, f"{i} " + "x" * int(rng.integers(1, 4000)), f"source{rng.integers(12)}", f"lang{rng.integers(6)}") for i in range(4000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string").repartition(4)
    dealt = hilbert.shards(docs).join(docs.select("doc_id", "source", "lang"), "doc_id")
    opened = lambda c: dealt.groupBy(c).agg(F.count_distinct("shard").alias("n")).agg(F.avg("n")).first()[0]
    assert opened("source") <= 9 and opened("lang") <= 11
    sizes = dealt.groupBy("shard").agg(F.min("size").alias("a"), F.max("size").alias("b")).collect()
    assert np.mean([any(r["a"] <= s <= r["b"] for s in (30,)) for r in sizes]) < 0.6
