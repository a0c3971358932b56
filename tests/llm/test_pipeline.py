"""The pipeline's stages against brute-force versions, each on its own input; the registered queries' contracts."""

import hashlib
import re

import pytest
from pyspark.sql import functions as F
from test_llm_operators import WINDOW, brute_components, brute_cover, brute_print

import corpus_pipeline
from askmine.llm import queries, suffix_dedup

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """Tables with planted cases: toxic texts, exact copies, a shared passage of over 50 words, a benchmark passage."""
    import numpy as np

    rng = np.random.default_rng(3)
    syllables = "the ing er on st re an ha ed ou in at é".split()
    prose = lambda n: " ".join("".join(rng.choice(syllables, rng.integers(1, 4))) for _ in range(n))
    passage, docs = prose(90), []
    for i in range(260):
        text = prose(int(rng.integers(40, 90)))
        if i % 6 == 0:
            words = text.split()
            words[5], words[12], words[20] = "idiot", "scum", "worthless"
            text = " ".join(words)
        docs.append(text)
    docs[1], docs[31], docs[62] = f"{docs[1]} {passage}", f"{docs[31]} {passage} {docs[31][:40]}", f"{passage} {docs[62]}"
    docs[3] = f"{docs[3]} {' '.join(WINDOW)} {docs[3][:60]}"
    docs += [docs[7], docs[7], docs[9], "", None, " "]
    path = tmp_path_factory.mktemp("tables")
    rows = [(i, t, "en", "s", len(t or "")) for i, t in enumerate(docs)]
    write = lambda data, schema, name: spark.createDataFrame(data, schema).write.parquet(str(path / f"{name}.parquet"))
    write(rows, "doc_id long, text string, lang string, source string, n_chars long", "documents")
    write([(i, 1, int(i % 6 == 0)) for i in range(260)], "doc_id long, quality int, toxic int", "labels")
    write([(i, rng.normal(size=8).tolist()) for i in range(45)], "vec_id long, embedding array<float>", "embeddings")
    write([(i, f"http://x.org/{i}", f"<p>{t}") for i, t in enumerate(docs)], "page_id long, url string, html string", "pages")
    write([(1, " ".join(WINDOW).title()), (2, None)], "item_id long, text string", "benchmark")
    return str(path)


def test_each_stage_on_its_own_input(spark, folder, tmp_path):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        before = {r["doc_id"]: r for r in docs.collect()}
        stage(spark, docs, folder).write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        seen[name] = before, {r["doc_id"]: r for r in docs.collect()}
        assert docs.columns == COLUMNS or name == "byte_bpe"
    before, after = seen["toxicity"]
    toxic = {i for i in before if i % 6 == 0 and i < 260}
    assert len(toxic & set(after)) <= 2 and len(set(before) - toxic - set(after)) <= 2
    before, after = seen["simhash_near_dedup"]
    prints = {i: brute_print(r["text"]) for i, r in before.items()}
    roots = brute_components(sorted(set(prints.values())), lambda a, b: (a ^ b).bit_count() <= 4)
    assert set(after) == {min(i for i in prints if roots[prints[i]] == roots[p]) for p in prints.values()}
    before, after = seen["suffix_array_dedup"]
    keys = sorted(before)
    values = [(before[i]["text"] or "").encode() for i in keys]
    for i, v, gone in zip(keys, values, brute_cover(values, 200)):
        kept = "".join(c for c, at in zip(v.decode(), _starts(v)) if not all(gone[at : at + len(c.encode())]))
        assert (after[i]["text"] or "") == kept and (after[i]["text"] is None) == (before[i]["text"] is None)
        assert after[i]["text"] is None or after[i]["n_chars"] == len(kept)
    assert sum(len(before[i]["text"] or "") - len(after[i]["text"] or "") for i in keys) > 3 * 400
    before, after = seen["benchmark_decontamination"]
    assert set(before) == set(after) and [i for i in before if before[i]["text"] != after[i]["text"]] == [3]
    assert re.sub(r"\s+", " ", after[3]["text"]) == re.sub(r"\s+", " ", before[3]["text"].replace(" ".join(WINDOW), ""))
    before, after = seen["byte_bpe"]
    assert {i: r["decoded_sha256"] for i, r in after.items()} == {i: hashlib.sha256((r["text"] or "").encode()).hexdigest() for i, r in before.items()}


def _starts(v: bytes) -> list[int]:
    return [i for i, b in enumerate(v) if b & 0xC0 != 0x80]


def test_run_is_the_stages(spark, folder):
    rows = corpus_pipeline.run(spark, folder)
    assert rows.count() > 150 and corpus_pipeline.ORACLE_SQL is None


CONTRACT = {
    "op1_bpe": ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
    "op2_warc": ["page_id", "warc_type", "record_id", "refers_to"],
    "op3_simhash": ["doc_id", "fingerprint", "component_id"],
    "op4_suffix_array": ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"],
    "op5_string_kernel": ["doc_id", "held_out", "score", "predicted"],
    "op6_repetition": ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"],
    "op7_hilbert": ["doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"],
    "op8_substring": ["doc_id", "n_words", "n_removed", "kept_sha256"],
    "op9_fourier": ["doc_id", "held_out", "score", "predicted"],
    "op10_fm_index": ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"],
    "op11_collocations": ["lang", "rank", "phrase", "a", "l", "r", "n", "score"],
    "op12_exact_topk": ["query_id", "rank", "vec_id", "score"],
    "op13_fill_middle": ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output_sha256", "restored_sha256"],
}
#: Distinct values of the first column where a query doesn't return a row per document or page: languages, and queries of the vectors.
KEYS = {"op11_collocations": 1, "op12_exact_topk": 3}


@pytest.mark.parametrize("name", queries.QUERIES)
def test_contract(spark, folder, name):
    df = queries.QUERIES[name](spark, folder)
    kinds = dict(df.dtypes)
    assert df.columns[: len(CONTRACT.get(name, []))] == CONTRACT.get(name, [])
    assert all(kinds[c] == "bigint" for c in df.columns if c.startswith("n_") or c in ("size", "content_length"))
    assert df.agg(F.count_distinct(df.columns[0])).first()[0] == KEYS.get(name, 266)


def test_characters_are_never_cut():
    import numpy as np

    data = np.frombuffer("aéé".encode(), np.uint8)
    kept = suffix_dedup._whole_characters(np.array([True, True, False, True, True]), data)
    assert kept.tolist() == [True, False, False, True, True]
