"""Odd rows and odd columns: repeated and null keys, empty tables, names with dots, spaces and those of the operators' own."""

import pytest

import corpus_pipeline
from askmine.llm import shingle_sets

LONG = "the ringing on heaters was in the house and on the street "
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, `a.b` int, `my col` string, row int, score double, key string, `c``d` int"


def odd(spark, pairs):
    rows = [(i, t, "en", "s", len(t or ""), n, "x", n, 0.5, "k", n) for n, (i, t) in enumerate(pairs)]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("odd")
    spark.createDataFrame([(i, 1, i % 2) for i in range(40)], "doc_id long, quality int, toxic int").write.parquet(str(path / "labels.parquet"))
    spark.createDataFrame([(1, "one two three four five six seven eight nine ten"), (2, None)], "item_id long, text string").write.parquet(str(path / "benchmark.parquet"))
    return str(path)


def texts(words):
    return " ".join(f"{w}{i}" for i, w in enumerate(words * 20))


A, B, C = texts(["alpha", "beta", "gamma"]), texts(["other", "text", "here"]), texts(["third", "one", "of", "them"])


def test_a_document_is_a_key_and_a_text(spark):
    left = lambda pairs: sorted(((r["doc_id"], r["text"]) for r in corpus_pipeline.one_of_each_group(spark, odd(spark, pairs), "").collect()), key=str)
    assert left([(1, A), (5, A), (5, B), (7, C), (7, C)]) == [(1, A), (5, B), (7, C)]
    assert left([(None, A), (3, A), (None, B), (None, B), (None, None), (None, " ")]) in ([(3, A), (None, B), (None, None)], [(3, A), (None, " "), (None, B)])
    assert left([(2, A), (2, A + " more"), (2, B), (2, B), (9, "")]) == sorted([(2, min([A, A + " more"], key=lambda t: hashed(spark, t))), (2, B), (9, "")], key=str)
    assert left([]) == []


def hashed(spark, text):
    return spark.createDataFrame([(text,)], "t string").selectExpr("xxhash64(t)").first()[0]


def test_components_of_repeated_keys(spark):
    rows = {(r["doc_id"], r["times"], r["component_id"], r["first"]) for r in shingle_sets.near_copies(odd(spark, [(4, A), (4, A), (4, B), (6, B), (None, C)])).collect()}
    assert rows == {(4, 2, 4, True), (4, 1, 4, True), (6, 1, 4, False), (None, 1, None, True)}


def test_every_stage_keeps_odd_columns_and_empty_tables(spark, folder):
    docs = odd(spark, [(i, LONG * 3 + f"{t} {i}" if t else t) for i, t in enumerate(["idiot", "calm", "", None, "one two three four five six seven eight nine ten", "calm"] * 6)] + [(3, "again"), (None, None)])
    for table in (docs, docs.limit(0)):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, table, folder)
            rows = out.collect()
            assert out.columns == docs.columns or name == "byte_bpe"
            assert bool(rows) == (table is docs)
            if name in ("suffix_array_dedup", "benchmark_decontamination", "byte_bpe") and rows:
                assert len(rows) == docs.count()
