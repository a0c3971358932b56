"""The pipeline's near-duplicates against all pairs of shingle sets: near copies at 0.8 to 0.95, chains and short texts."""

import re

import numpy as np
from test_llm_operators import brute_components

import corpus_pipeline

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_set(text):
    words = WORD.findall((text or "").lower())
    return {" ".join(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def similar(a, b):
    return a == b or 5 * len(a & b) >= 4 * len(a | b)


def test_near_copies_go(spark):
    rng = np.random.default_rng(11)
    vocabulary = [f"{a}{b}" for a in ("the", "on", "st", "re", "an") for b in ("er", "ing", "ed", "ou", "at", "")]
    prose = lambda n: list(rng.choice(vocabulary, n))
    rows, n_planted = [], 0
    for _ in range(40):
        base = prose(int(rng.integers(60, 400)))
        rows.append(" ".join(base))
        for gone in (0.02, 0.05, 0.1, 0.13):
            copy = list(base)
            for i in rng.choice(len(base), max(1, int(len(base) * gone / 5)), replace=False):
                copy[i] = "changed"
            rows.append(" ".join(copy))
            n_planted += similar(brute_set(rows[-1]), brute_set(" ".join(base)))
    passage = prose(40)
    rows += [" ".join(passage + prose(int(n))) for n in rng.integers(5, 60, 40)]
    large = prose(150)
    for _ in range(60):
        copy = list(large)
        copy[int(rng.integers(150))] = "other"
        rows.append(" ".join(copy))
    rows += ["", None, " \n", "one", "One", "one two", "a b c d e f g h i", "a b c d e f g h i j", "x " * 50, "x " * 500]
    df = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string").repartition(5)
    left = {r["doc_id"] for r in corpus_pipeline.one_of_each_group(spark, df, "").collect()}
    sets = [brute_set(t) for t in rows]
    roots = brute_components(range(len(rows)), lambda a, b: similar(sets[a], sets[b]))
    assert n_planted > 100 and left == {i for i, r in roots.items() if i == r}


def test_no_rows(spark):
    assert corpus_pipeline.one_of_each_group(spark, spark.createDataFrame([], "doc_id long, text string"), "").count() == 0
