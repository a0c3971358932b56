"""A benchmark in several blocks gives the rows of one block; a block takes a small multiple of its text."""

import tracemalloc

import numpy as np
import pytest
from test_llm_operators import docs, empty, items  # noqa: F401

from askmine.llm import decontaminate


@pytest.mark.parametrize("shard_bytes", [300, 1 << 20])
def test_blocks_of_the_benchmark(spark, docs, shard_bytes):  # noqa: F811
    bench = spark.createDataFrame(items(), "item_id long, text string")
    rows = lambda **how: sorted(map(str, decontaminate.find(docs, bench, **how).select("doc_id", "n_words", "n_hit", "items", "spans").collect()))
    assert rows(shard_bytes=shard_bytes, block_bytes=40) == rows()


def test_memory_of_a_block():
    rng = np.random.default_rng(2)
    words = np.array([f"{a}{b}" for a in "the on st re an ing ed ou".split() for b in range(400)])
    texts = [" ".join(rng.choice(words, 200)) for _ in range(1500)]
    size = sum(map(len, texts))
    tracemalloc.start()
    queries = decontaminate.Queries([str(i) for i in range(len(texts))], texts, 10)
    kept = sum(x.nbytes for x in (queries.vocabulary, queries.words, queries.edges))
    opened = queries.opened()
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert kept < size and opened.n > 200_000 and peak < 60 * size


def test_a_benchmark_without_bound_is_refused(spark, monkeypatch):
    monkeypatch.setattr(decontaminate, "MOST_BYTES", 10)
    with pytest.raises(ValueError):
        decontaminate.shared_queries(spark.createDataFrame([(1, "a longer text")], "item_id long, text string"), "item_id", "text", 10)
