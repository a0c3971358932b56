import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from askmine.functions import arrow, cleaning
from askmine.functions import text as t
from askmine.operators import chunking, dedupe, hierarchy, similar


def test_a_row_that_repeats_an_id_of_a_later_round(spark):
    rows = [(1, "a", "p"), (2, "a", "q"), (3, "b", "q"), (4, "b", "p")]  # 3 is accepted after 2 is dropped, and 4 repeats its id
    df = spark.createDataFrame(rows, "at long, id string, print string")
    got = {r["at"]: r["drop_reason"] for r in dedupe.accepted_in_order(df, "at", F.col("id"), F.col("print")).collect()}
    assert list(got[i] for i in (1, 2, 3, 4)) == [None, "dup_id", None, "dup_id"] == dedupe.scan_in_order(pd.DataFrame([r[1:] for r in rows]))


def test_references_that_nothing_closes():
    page = "<h1>a &amp;&amp; b&amp</h1>&lt;&copy;&#65;&nosuch;&ampx;"
    assert cleaning.html_to_text(page, cleaning.closed_references) == "\na && b&amp\n<©A&nosuch;&ampx;"
    assert cleaning.html_to_text("<h1>b&amp</h1>") == "\nb&\n"  # as browsers do, by default


def test_quote_headers_begin_at_ascii_words():
    assert cleaning.strip_quoted("own\nOnè day\nAnn wrote:\nold") == "own"
    assert cleaning.strip_quoted("own\nOne day\nAnn wrote:\nold") == "own\nOne day\nAnn wrote:\nold"


def test_flat_quotes_begin_at_ascii_words(spark):
    texts = ["own. Onè day. On Monday at 07:23, Ann wrote: x", "own. Only at 07:23, Ann wrote: x"]
    df = spark.createDataFrame([(x,) for x in texts], "x string").select(t.without_flat_quote(F.col("x")).alias("y"))
    assert [r["y"] for r in df.collect()] == ["own.", texts[1]]


def test_texts_are_read_in_slices():
    assert list(arrow.slices(np.array([3, 3, 9, 1, 1]), 6, 2)) == [(0, 2), (2, 3), (3, 5)]
    assert list(arrow.slices(np.array([], int))) == []
    assert list(arrow.slices(np.zeros(2500, int))) == [(0, 1024), (1024, 2048), (2048, 2500)]


def test_a_filter_on_chunks_cuts_no_text_twice(spark):
    docs = spark.createDataFrame([(1, "one two"), (2, None), (3, "w " * 301)], "k long, text string")
    few = chunking.chunked(docs, "text", keep_empty=True).filter("n_chunks = 1")
    assert few._jdf.queryExecution().optimizedPlan().toString().count("ArrowEvalPython") == 1
    assert [tuple(r) for r in few.select("k", "n_words", "text").collect()] == [(1, 2, "one two")]


def test_edges_of_many_leaves_are_cut_to_forests(spark):
    rng = np.random.default_rng(5)
    points = rng.normal(size=(500, 2))
    df = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(points)], "id long, point array<double>")
    cored = hierarchy.with_cores(hierarchy.packed_leaves(df, 500, 2, leaf=16), 2, 5)
    rows = hierarchy.edges(cored, 2, 5, 5).collect()
    d = hierarchy.distances(points, points)
    core = np.sort(d, axis=1)[:, 4]
    w, a, b = hierarchy.spanning_tree(points, core, np.arange(500))
    found = {(r["w"], r["a"], r["b"]) for r in rows}
    assert {(x, min(y, z), max(y, z)) for x, y, z in zip(w.tolist(), a.tolist(), b.tolist())} <= found
    assert len(rows) <= hierarchy.MOST_SIDE * 500  # 8 x 8 tiles joined to 2 x 2; every pair of leaves gave its own before


def test_runs_are_counted_by_hashes(spark):
    docs = spark.createDataFrame([(1, "a b c d e f"), (2, "A b, c d e"), (3, "a b"), (4, None)], "k long, text string")
    got = similar.run_counts(docs, "text")
    assert dict(got.dtypes) == {"first": "bigint", "second": "int", "n": "bigint"}  # no text is shuffled
    assert sorted(r["n"] for r in got.collect()) == [1, 2] == sorted(r["n"] for r in similar.run_frequencies(docs, "k", "text").collect())
