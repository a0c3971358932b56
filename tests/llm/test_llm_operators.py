"""Every operator against a brute-force version, on rows with nulls, empty and long texts, ties and clashing columns."""

import base64
import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from askmine.llm import bpe, components, decontaminate, hilbert, quality, repetition, simhash, substring_dedup, suffix_dedup, toxicity

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, key string, row int, n_words int, block int"
PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")
WORD = re.compile(r"[^\x20\x09-\x0D]+")
WINDOW = "alpha bravo charlie delta echo foxtrot golf hotel india juliet kilo lima mike november oscar papa quebec romeo sierra tango".split()


def texts() -> list[tuple]:
    """(doc_id, text): copies, near copies, shared passages, repeated lines, nulls, empty and very long texts."""
    rng = np.random.default_rng(7)
    vocabulary = [f"{a}{b}{c}" for a in ("Th", "on", "é", "ß", "st") for b in ("er", "ing", "'s", "12", "ö") for c in ("a", ".", "re", "!!", "")]
    make = lambda n: " ".join(rng.choice(vocabulary, n))
    passage, long_ = " ".join(WINDOW) + " " + make(40), make(6000)
    rows = [make(int(n)) for n in rng.integers(1, 120, 40)]
    rows += [rows[3], rows[3], rows[5] + " tail", "head " + rows[5], make(30) + " " + passage + "\n" + make(5), make(3) + "\t" + passage, passage, long_, long_[: len(long_) // 2], make(10) + " " + long_[4000:9000]]
    rows += ["same line here\n" * 60, "ab " * 500, "x" * 700, "é" * 300, "é" * 101, "", " \n\t ", None, None, "one", "one two", "naïve — “quotes” 你好 🙂 " * 30]
    return list(enumerate(rows)) + [(3, rows[3]), (3, "another text under a known id"), (None, passage)]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "en", f"s{(i or 0) % 3}", len(t or ""), "k", 1, 2, 3) for i, t in texts()]
    return spark.createDataFrame(rows, SCHEMA).repartition(5)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def test_bpe_is_the_library(spark, docs, empty):
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(PATH, "rb"))}
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    encoded = bpe.encode(docs, PATH)
    got = Counter((r["doc_id"], bytes(r["ids"]), bytes(r["decoded"])) for r in bpe.decode(encoded, PATH).collect())
    assert got == Counter((i, np.array(library.encode_ordinary(t or ""), "<u4").tobytes(), (t or "").encode()) for i, t in texts())
    assert all(np.frombuffer(r["ends"], "<u4")[-1:].sum() == len((dict(texts()[:-3]).get(r["doc_id"]) or "").encode()) for r in encoded.collect() if r["doc_id"] not in (None, 3))
    assert bpe.encode(empty, PATH).count() == 0


VOCABULARY = bpe.Vocabulary(open(PATH, "rb").read())
LIBRARY = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=VOCABULARY.ranks, special_tokens={})


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(st.sampled_from("ab'stremvlldd  \n\t 12é你!?.　'’#Z🙂")), max_size=4))
def test_bpe_pieces(some):
    assert [x.tolist() for x in VOCABULARY.encode(some)] == [LIBRARY.encode_ordinary(t) for t in some]


@settings(max_examples=100, deadline=None)
@given(st.text(max_size=40), st.sampled_from(["a" * 400, "ab" * 200, "é" * 150, "0" * 97]))
def test_bpe_long_pieces(a, b):
    assert VOCABULARY.encode([a + b])[0].tolist() == LIBRARY.encode_ordinary(a + b)


def brute_print(text):
    words = WORD.findall((text or "").translate({c: c + 32 for c in range(65, 91)}))
    runs = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    hashes = [xxhash.xxh64_intdigest(x.encode(), 42) for x in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(nodes, linked):
    root = {n: n for n in nodes}
    find = lambda x: x if root[x] == x else find(root[x])
    for i, a in enumerate(nodes):
        for b in nodes[i + 1 :]:
            if linked(a, b) and (x := find(a)) != (y := find(b)):
                root[max(x, y)] = min(x, y)
    return {n: find(n) for n in nodes}


def test_simhash(spark, docs, empty):
    prints = [(i, brute_print(t)) for i, t in texts()]
    roots = brute_components(sorted({p for _, p in prints}), lambda a, b: (a ^ b).bit_count() <= 4)
    least = defaultdict(lambda: math.inf)
    for i, p in prints:
        least[roots[p]] = min(least[roots[p]], math.inf if i is None else i)
    got = Counter((r["doc_id"], r["fp"] % (1 << 64), r["component_id"]) for r in simhash.near_duplicates(docs).collect())
    assert got == Counter((i, p, least[roots[p]]) for i, p in prints)
    assert simhash.near_duplicates(empty).count() == 0


@pytest.mark.parametrize(("groups", "hot"), [(6, 4096), (7, 3), (8, 1)])
def test_links_lose_none(spark, groups, hot):
    rng = np.random.default_rng(groups)
    prints = {int(x) for x in rng.integers(0, 1 << 63, 40)} | {0, (1 << 64) - 1}
    for p in list(prints)[:25]:
        for _ in range(6):
            prints.add(p := p ^ sum(1 << int(b) for b in rng.choice(64, int(rng.integers(1, 6)), replace=False)))
    nodes = sorted(prints)
    df = spark.createDataFrame([(n - (1 << 64) if n >> 63 else n,) for n in nodes], "fp long")
    edges = simhash.links(df, 4, groups, hot)
    found = {r["node"] % (1 << 64): r["root"] for r in components.components(edges).collect()}
    expected = brute_components(nodes, lambda a, b: (a ^ b).bit_count() <= 4)
    same = lambda of: {frozenset(k for k in nodes if of(k) == v) for v in map(of, nodes)}
    assert same(lambda n: found.get(n, n)) == same(expected.get)


def test_components_of_a_long_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(100)] + [(200, 300), (300, 300), (200, 300)], "a long, b long")
    got = {r["node"]: r["root"] for r in components.components(edges).collect()}
    assert got == {**{i: 0 for i in range(101)}, 200: 200, 300: 200}
    assert components.components(edges.limit(0)).count() == 0


def brute_cover(values, length):
    seen = Counter(v[i : i + length] for v in values for i in range(len(v) - length + 1))
    for v in values:
        gone = bytearray(len(v))
        for i in range(len(v) - length + 1):
            if seen[v[i : i + length]] > 1:
                gone[i : i + length] = b"\1" * length
        yield gone


@pytest.mark.parametrize("block_bytes", [2000, 4 << 20])
def test_suffix_dedup(docs, empty, block_bytes):
    values = [(t or "").encode() for _, t in texts()]
    expected = Counter()
    for (i, _), v, gone in zip(texts(), values, brute_cover(values, 200)):
        spans = [x for m in re.finditer(rb"\x01+", bytes(gone)) for x in m.span()]
        expected[i, len(v), sum(gone), tuple(spans), bytes(c for c, g in zip(v, gone) if not g)] += 1
    done = suffix_dedup.remove_repeats(docs, block_bytes=block_bytes).collect()
    assert Counter((r["doc_id"], r["n_bytes"], r["n_removed"], tuple(r["spans"]), bytes(r["kept"])) for r in done) == expected
    assert sum(k[2] * n for k, n in expected.items()) > 10_000
    assert suffix_dedup.remove_repeats(empty).count() == 0
    whole = suffix_dedup.remove_repeats(docs, block_bytes=block_bytes, whole_characters=True, carry=True).collect()
    assert all(r["kept"] is None or bytes(r["kept"]).decode() is not None for r in whole)
    assert Counter(r["row"]["n_words"] for r in whole) == {2: len(texts())} and sum(r["kept"] is None for r in whole) == 2


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(st.sampled_from("ab"), min_size=0, max_size=70), min_size=1, max_size=12))
def test_deep_shallow_sorts(strings):
    rows = np.array([np.frombuffer(s.encode().ljust(72, b"\0"), np.uint8) for s in strings])
    order, common = suffix_dedup.deep_shallow(rows, shallow=8)
    padded = [s.encode().ljust(72, b"\0") for s in strings]
    assert [padded[i] for i in order] == sorted(padded)
    for a, b, n in zip(order, order[1:], common[1:]):
        assert n == next((k for k in range(72) if padded[a][k] != padded[b][k]), 72)


@pytest.mark.parametrize("block_bytes", [2000, 4 << 20])
def test_substring_dedup(docs, empty, block_bytes):
    rows = [(-1 if i is None else i, i, WORD.findall(t or "")) for i, t in texts()]
    least = {}
    for k, _, w in rows:
        for j in range(len(w) - 12):
            least[tuple(w[j : j + 13])] = min(k, least.get(tuple(w[j : j + 13]), k))
    expected = Counter()
    for k, i, w in rows:
        gone = [any(least[tuple(w[j : j + 13])] < k for j in range(max(0, p - 12), min(p, len(w) - 13) + 1)) for p in range(len(w))]
        expected[i, len(w), sum(gone), " ".join(x for x, g in zip(w, gone) if not g)] += 1
    done = substring_dedup.remove_repeated_windows(docs, block_bytes=block_bytes).collect()
    assert Counter((r["doc_id"], r["n_words"], r["n_removed"], r["kept"]) for r in done) == expected
    assert substring_dedup.remove_repeated_windows(empty).count() == 0


def items():
    return [(0, " ".join(WINDOW)), (1, "Kilo, LIMA mike"), (2, None), (3, " .,- "), (4, " ".join(WINDOW[5:])), (4, "naïve “quotes”"), (10, " ".join(WINDOW[:9])), (11, "Thera")]


@pytest.mark.parametrize("shard_bytes", [300, 4 << 20])
def test_decontamination(spark, docs, empty, shard_bytes):
    words = lambda t: re.findall(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").encode().translate(bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))))
    windows = defaultdict(set)
    for item, t in items():
        w = words(t)
        for i in range(max(1, len(w) - 9) if w else 0):
            windows[tuple(w[i : i + 10])].add(str(item))
    expected = Counter()
    for i, t in texts():
        w = words(t)
        hit, own = set(), set()
        for n in {len(x) for x in windows}:
            for j in range(len(w) - n + 1):
                if (x := tuple(w[j : j + n])) in windows:
                    hit.update(range(j, j + n))
                    own |= windows[x]
        expected[i, len(w), len(hit), tuple(sorted(own))] += 1
    bench = spark.createDataFrame(items(), "item_id long, text string")
    done = decontaminate.find(docs, bench, shard_bytes=shard_bytes, carry=True).collect()
    assert Counter((r["doc_id"], r["n_words"], r["n_hit"], tuple(r["items"])) for r in done) == expected
    cut = lambda t, gaps: None if t is None else "".join(t.encode()[a:b].decode() for a, b in zip([0, *gaps][::2], [*gaps, len(t.encode())][::2]))
    known = defaultdict(set)
    for i, t in texts():
        known[i].add(t)
    assert all(r["cleaned"] in {cut(t, r["spans"]) for t in known[r["doc_id"]] if t is None or not r["spans"] or len(t.encode()) >= r["spans"][-1]} for r in done)
    assert {r["row"]["n_words"] for r in done} == {2} and any(r["spans"] for r in done)
    assert decontaminate.find(empty, bench).count() == 0
    assert decontaminate.find(docs, bench.limit(0)).filter("n_hit > 0").count() == 0


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 3), min_size=1, max_size=60), st.lists(st.integers(1, 3), min_size=1, max_size=4))
def test_fm_index(text, query):
    text = np.array([*text, 0])
    index = decontaminate.FMIndex(text, 4)
    low, high = index.search(np.array(query[::-1])[:, None])
    found = sorted(index.locate(np.arange(low[0], max(low[0], high[0]))).tolist())
    assert found == [i for i in range(len(text) - len(query) + 1) if text[i : i + len(query)].tolist() == query]


def test_repetition(docs, empty):
    def expected(i, t):
        t = t or ""
        w = WORD.findall(t)
        marked = lambda n: sum(any(seen[n][tuple(w[j : j + n])] > 1 for j in range(max(0, p - n + 1), min(p, len(w) - n) + 1)) for p in range(len(w)))
        seen = {n: Counter(tuple(w[j : j + n]) for j in range(len(w) - n + 1)) for n in (3, 8)}
        lines = [x for x in t.split("\n") if WORD.search(x)]
        return i, len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), marked(3), marked(8)

    names = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_covered"]
    got = repetition.judge(repetition.measure(docs)).collect()
    assert Counter(tuple(r[c] for c in names) for r in got) == Counter(expected(i, t) for i, t in texts())
    assert all(r["base_failed"] == (r["n_words"] < 50 or 100 * r["n_repeat_words"] > 50 * r["n_words"]) for r in got)
    assert not any(r["kept"] and r["base_failed"] for r in got) and any(r["kept"] for r in got)
    assert repetition.measure(empty).count() == 0


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 2), max_size=60))
def test_shared_prefixes(symbols):
    got = repetition.shared_prefixes(np.array(symbols, np.uint64))
    common = lambda a, b: next((k for k in range(len(symbols)) if max(a, b) + k >= len(symbols) or symbols[a + k] != symbols[b + k]), len(symbols))
    for i in range(len(symbols)):
        assert got[i] == max(2, *(common(i, j) for j in range(len(symbols)) if j != i), 2)


@pytest.mark.parametrize(("dims", "bits"), [(2, 4), (3, 3), (4, 2)])
def test_curve_is_a_hilbert_curve(spark, dims, bits):
    cells = spark.range(1 << bits * dims).select(*[((F.col("id").cast("int") / F.lit(1 << bits * d)).cast("int") % (1 << bits)).alias(f"x{d}") for d in range(dims)])
    rows = cells.select("*", hilbert.curve_index([F.col(f"x{d}") for d in range(dims)], bits).alias("place")).orderBy("place").collect()
    assert [r["place"] for r in rows] == list(range(1 << bits * dims))
    assert all(sum(abs(a - b) for a, b in zip(x[:-1], y[:-1])) == 1 for x, y in zip(rows, rows[1:]))


def test_shards(spark, docs, empty):
    more = spark.createDataFrame([(1000 + i, "copy of a text " * 9, "en", "s0", 1, "k", 1, 2, 3) for i in range(400)] + [(5000 + i, f"text {i} " * 20, "de", "s1", 1, "k", 1, 2, 3) for i in range(900)], SCHEMA)
    every = docs.unionByName(more)
    got, source = hilbert.shards(every).collect(), [(r["doc_id"], r["text"]) for r in every.collect()]
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in got) == Counter((i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in source)
    sizes, slots = Counter(), defaultdict(list)
    for r in got:
        sizes[r["shard"]] += r["size"]
        slots[r["shard"]].append(r["slot"])
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())
    target, largest = sum(sizes.values()) / 16, max(r["size"] for r in got)
    assert max(sizes.values()) <= 1.1 * target + largest and set(sizes) <= set(range(16))
    assert hilbert.shards(empty).count() == 0
    plan = hilbert.shards(every)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_isotonic():
    from askmine.llm.calibrate import calibrated, isotonic

    knots = isotonic(np.array([0.0, 1, 2, 3]), np.array([0.0, 1, 0, 1]), np.full(4, 100.0))
    p = calibrated(np.linspace(-5, 8, 50), knots)
    assert (np.diff(p) >= 0).all() and 0 <= p.min() < 0.02 and p.max() > 0.98
    assert calibrated(np.array([1.5]), knots)[0] == pytest.approx(0.5, abs=0.01)


@pytest.fixture(scope="module")
def labelled(spark):
    rng = np.random.default_rng(11)
    syllables = "the ing er on st re an ha ed ou in at".split()
    word = lambda: "".join(rng.choice(syllables, rng.integers(1, 4)))
    insults, docs, labels = ("worthless", "idiot", "scum", "pathetic"), [], []
    for i in range(700):
        toxic, bad = i % 5 == 0, i % 4 == 1
        words = [word() for _ in range(rng.integers(30, 90))]
        for at in rng.integers(0, len(words), 3 * toxic):
            words[at] = str(rng.choice(insults))
        text = ". ".join(" ".join(words[j : j + 9]) for j in range(0, len(words), 9))
        docs.append((i, " ".join(w + "###" for w in text.split()) if bad else text))
        labels.append((i, int(not bad), int(toxic)))
    docs += [(900, None), (901, ""), (902, " "), (903, "the ring. " * 3000)]
    return spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame([*labels, (900, None, None), (999, 1, 1)], "doc_id long, quality int, toxic int")


def crc(of):
    return F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(of))


def accuracy(scored, labels, label, held):
    rows = scored.join(labels, "doc_id").filter(held).filter(F.col(label).isNotNull()).select("score", label).collect()
    return np.mean([(r["score"] >= 0.7) == (r[label] == 1) for r in rows])


def test_quality(labelled, empty):
    docs, labels = labelled
    got = quality.score(docs, labels, learn=crc(4) != 2)
    assert got.count() == docs.count() and got.filter("score is null or score < 0 or score > 1 or isnan(score)").count() == 0
    assert accuracy(got, labels, "quality", crc(4) == 2) > 0.95
    assert quality.score(empty, labels).count() == 0
    assert {r["score"] for r in quality.score(docs.limit(3), labels.limit(0)).collect()} == {0.5}


def test_toxicity(spark, labelled, empty):
    docs, labels = labelled
    model = toxicity.fit(docs, labels, learn=crc(3) != 1)
    got = toxicity.score(docs, model)
    assert got.count() == docs.count() and got.filter("score is null or score < 0 or score > 1 or isnan(score)").count() == 0
    assert accuracy(got, labels, "toxic", crc(3) == 1) > 0.9
    plain = "the ringing on heaters. %s in the house ander on. " * 3
    score = lambda w: float(model.scores(pa.array([plain.replace("%s", w)]))[0])
    assert all(score(w) >= 0.7 for w in ("idiot", "IDIOT!", "i d i o t", "id-iot", "i.d.i.o.t", "worthless", "sc_um"))
    assert score("worthxless") > 2 * score("ringer") and all(score(w) < 0.5 for w in ("ringer", "theater", "instead"))
    assert toxicity.score(empty, model).count() == 0
    assert set(toxicity.Model(["a"], np.array([False])).scores(pa.array(["x", None]))) == {0.5}
    assert toxicity.score(docs, toxicity.fit(docs, labels.limit(0)), carry=True).select("row.text", "score").filter("score = 0.5").count() == docs.count()


@settings(max_examples=60, deadline=None)
@given(st.text(st.sampled_from("abc"), min_size=1, max_size=7), st.text(st.sampled_from("abc"), min_size=1, max_size=7))
def test_string_kernel(s, t):
    from itertools import combinations

    def weights(x):
        out = Counter()
        for at in combinations(range(len(x)), toxicity.ORDER):
            out["".join(x[i] for i in at)] += toxicity.DECAY ** (at[-1] - at[0] + 1)
        return out

    a, b = weights(s), weights(t)
    expected = sum(a[u] * b[u] for u in a)
    got = toxicity.subsequence_kernel(toxicity.encoded(s)[None], toxicity.encoded(t)[None])[0]
    assert got == pytest.approx(expected, rel=1e-4, abs=1e-6)
