"""Collocations, exact top-k and fill-in-the-middle against brute force, on nulls, empty and long texts, ties and repeats."""

import hashlib
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from askmine.llm import collocations, exact_topk, fill_middle

SCHEMA = "doc_id long, text string, lang string, phrase string, f long, row int, `a.b` int, n int"
UPPER = {ord(c): c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}


def documents(spark, rows):
    return spark.createDataFrame([(i, t, g, "x", 1, 2, 3, 4) for i, t, g in rows], SCHEMA)


def prose(seed=3, n=120):
    rng = np.random.default_rng(seed)
    words = ["the", "The", "of", "new", "york", "city", "hall", "Été", "x y", "ß"]
    rows = []
    for i in range(n):
        text = " ".join(rng.choice(words, int(rng.integers(1, 40)), p=[0.3, 0.1, 0.1, 0.1, 0.1, 0.1, 0.05, 0.05, 0.05, 0.05]))
        rows.append((i, text.replace("hall", "hall.") + ("\tnew york city" * int(rng.integers(0, 3))), ["en", None, "und", "fr"][i % 4]))
    return rows + [(900, None, "en"), (901, "", None), (902, " \t ", "xx"), (903, "one", "yy"), (None, "new york city " * 3000, "en"), (5, "new york", "en"), (5, "new york", "en")]


def plain_collocations(rows, max_n, min_count, percent, top):
    f, total = defaultdict(Counter), Counter()
    for _, text, lang in rows:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(UPPER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            total[lang or "und"] += len(words)
            for n in range(1, max_n + 1):
                f[lang or "und"].update(tuple(words[i : i + n]) for i in range(len(words) - n + 1))
    out = []
    for lang, counts in f.items():
        candidates = {p: a for p, a in counts.items() if len(p) > 1 and a >= min_count}
        found = []
        for p, a in candidates.items():
            score, _, l, r = min((10**6 * a * a // (counts[p[:k]] * counts[p[k:]]), k, counts[p[:k]], counts[p[k:]]) for k in range(1, len(p)))
            around = [b for q, b in candidates.items() if len(q) > len(p) and any(q[i : i + len(p)] == p for i in range(len(q) - len(p) + 1))]
            if not any(100 * b >= percent * a for b in around):
                found.append((-score, -a, " ".join(p).encode(), l, r))
        out += [(lang, i + 1, p.decode(), -a, l, r, total[lang], -s) for i, (s, a, p, l, r) in enumerate(sorted(found)[:top])]
    return sorted(out)


@pytest.mark.parametrize("max_n, top", [(3, 2000), (3, 7), (2, 2000), (5, 2000)])
def test_collocations(spark, max_n, top):
    rows = prose()
    got = collocations.collocations(documents(spark, rows), max_n=max_n, top=top)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert sorted(map(tuple, got.collect())) == plain_collocations(rows, max_n, 10, 50, top)


def test_collocations_of_nothing(spark):
    assert collocations.collocations(documents(spark, [])).count() == 0
    assert collocations.collocations(documents(spark, [(1, None, None), (2, "a b", "en")])).count() == 0


def test_scores_are_exact_beyond_64_bits(spark):
    big = 3_000_000_000_000
    grams = spark.createDataFrame([("en", "a b", big - 1, 2), ("en", "a", big, 1), ("en", "b", big + 7, 1)], "lang string, phrase string, f long, n_words int")
    assert collocations.scored(grams).first()["score"] == 10**6 * (big - 1) ** 2 // (big * (big + 7))


def test_long_pieces_are_taken_in_runs(spark, monkeypatch):
    monkeypatch.setattr(collocations, "LONG", 20)
    monkeypatch.setattr(collocations, "RUN", 4)
    rows = [*prose(6), (7, " " * 40, "zz"), (8, "a b c d " * 30 + "e", "en")]
    assert sorted(map(tuple, collocations.collocations(documents(spark, rows), max_n=4).collect())) == plain_collocations(rows, 4, 10, 50, 2000)


def test_full_bits_lose_nothing(spark, monkeypatch):
    monkeypatch.setattr(collocations, "BITS_ROWS", 1)
    rows = prose(4)
    assert sorted(map(tuple, collocations.collocations(documents(spark, rows)).collect())) == plain_collocations(rows, 3, 10, 50, 2000)


def plain_top(rows, k):
    rows = [(i, [int(np.floor(64 * float(x))) for x in v]) for i, v in rows if v is not None and all(x is not None and np.isfinite(x) for x in v)]
    out = []
    for a, (i, q) in enumerate(rows):
        if i is not None and i % 20 == 0:
            scored = [(-sum(x * y for x, y in zip(q, v)), j is None, j or 0) for b, (j, v) in enumerate(rows) if b != a]
            out += [(i, r + 1, None if null else j, -s) for r, (s, null, j) in enumerate(sorted(scored)[:k])]
    return sorted(out, key=str)


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, 1, 2, "x") for i, v in rows], "vec_id long, embedding array<double>, row int, score int, `a.b` string")


def some_vectors(n=400, scale=1.0):
    rng = np.random.default_rng(11)
    rows = [(i, (rng.normal(size=9) * scale).tolist()) for i in range(n)]
    rows += [(1000 + i, rows[3][1]) for i in range(150)]  # one very common vector
    rows += [(20, rows[4][1]), (20, rows[20][1]), (40, [float("nan")] * 9), (60, None), (80, [1.0, None]), (None, rows[40][1]), (100, []), (120, [0.5, 1.0]), (7, [float("inf")])]
    return rows


@pytest.mark.parametrize("scale", [1.0, 1e4, 1e9])
@pytest.mark.parametrize("lists, block", [(2, 8192), (3, 100), (1, 64)])
def test_exact_top_k(spark, scale, lists, block):
    rows = some_vectors(scale=scale) if scale < 1e9 else some_vectors(60, 1e6)
    got = exact_topk.top_k(vectors(spark, rows), k=20, lists=lists, block=block)
    assert sorted(map(tuple, got.collect()), key=str) == plain_top(rows, 20)


def test_top_k_of_few_rows_and_of_large_scores(spark):
    few = [(0, [1.0]), (20, [2.0]), (3, [-1.0])]
    assert sorted(map(tuple, exact_topk.top_k(vectors(spark, few)).collect())) == plain_top(few, 20)
    assert exact_topk.top_k(vectors(spark, [])).count() == exact_topk.top_k(vectors(spark, few[:1])).count() == 0
    wide = [(0, [2.0**20, 1.0]), (1, [2.0**20, 3.0]), (2, [2.0**19, -5.0])]
    assert sorted(map(tuple, exact_topk.top_k(vectors(spark, wide)).collect())) == plain_top(wide, 20)
    with pytest.raises(Exception, match="62 bits"):
        exact_topk.top_k(vectors(spark, [(0, [2.0**40]), (1, [2.0**40])])).collect()


def test_a_threshold_opens_few_entries(spark):
    """Phase 2 sums whole scores of what reaches the cutoff in a list, less than a fifth of all even of so few."""
    rng = np.random.default_rng(2)
    import pyarrow as pa

    values = np.floor(64 * rng.normal(size=(3000, 64)) / 8)
    held = pa.table({"x": pa.array(values.tolist(), pa.list_(pa.float64())), "row": np.arange(3000)})
    cell, opened = exact_topk.Cell(held.slice(0, 50), held, 2), []
    cell.whole, whole = lambda q, c: opened.append(len(q)) or whole(q, c), cell.whole
    best = np.concatenate([s for _, s in exact_topk._best_of_lists(cell, 20)])
    opened.clear()
    kept = sum(len(s) for _, _, s in exact_topk._reaching(cell, best[:, -1]))
    assert 50 * 20 <= kept < sum(opened) < 0.2 * 50 * 3000


def plain_fim(key, text, percent=50):
    text = text or ""
    tokens = re.findall(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+", text)
    digest = hashlib.sha256(f"42:{'' if key is None else key}".encode()).hexdigest()
    h, n = [int(digest[8 * i : 8 * i + 8], 16) for i in range(4)], len(tokens)
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    pre, mid, suf = ("".join(x) for x in (tokens[:a], tokens[a:b], tokens[b:]))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= percent:
        return key, n, "plain", None, None, text
    form = "spm" if h[3] % 100 < 80 else "psm"
    return key, n, form, len(pre), len(mid), f"<P>{pre}<S>{suf}<M>{mid}" if form == "psm" else f"<S>{suf}<P>{pre}<M>{mid}"


ODD = ["", None, " ", "\n\t x", "a", "a ", " a", "a  b c", "é ü", "你好 世界 🙂 x", "<P> in it", "a <S", "<", "<M", "><M>", "M> <", "x\x0b\x0cy\x85z\x1cw", "long word " * 40_000, "é" * 9000, " " * 5000]


def test_fill_middle(spark):
    rows = [(i, ODD[i % len(ODD)], "en") for i in range(6 * len(ODD))] + [(None, "a b c d", "en"), (3, "x y z", "en"), (3, "x y z", "en")]
    made = fill_middle.transform(documents(spark, rows).repartition(3), carry=True)
    got = made.select("doc_id", "n", "form", "prefix_chars", "middle_chars", "output", fill_middle.restored().alias("back"), "row.text", "row.`a.b`").collect()
    assert Counter(tuple(r)[:6] for r in got) == Counter(plain_fim(i, t) for i, t, _ in rows)
    assert all(r["back"] == (r["text"] or "") and r["a.b"] == 3 for r in got)
    assert {r["form"] for r in got} == set(fill_middle.FORMS)
    assert fill_middle.transform(documents(spark, [])).count() == 0


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(st.sampled_from(" \tab<PSM>é🙂\n"), max_size=12), min_size=1, max_size=8))
def test_a_batch_is_cut_as_each_text_alone(texts):
    import pyarrow as pa

    digests = [hashlib.sha256(f"42:{i}".encode()).hexdigest() for i in range(len(texts))]
    h = [np.array([int(d[8 * i : 8 * i + 8], 16) for d in digests]) for i in range(4)]
    column = pa.array(["before ", *texts, " after"], pa.string()).slice(1, len(texts))
    got = list(zip(*(c.to_pylist() for c in fill_middle.cut(column, h, 100, 80))))
    assert got == [plain_fim(i, t, 100)[1:] for i, t in enumerate(texts)]
