"""What large tables cost: rows that go through shuffles, and what one task gets of them."""

import math
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from askmine.functions import text
from askmine.operators import seeding, similar, terms
from askmine.operators.zones import with_zone


def shuffled_records(spark, run) -> int:
    """Records that the stages of run() wrote to shuffles."""
    sc, jvm = spark.sparkContext._jsc.sc(), spark.sparkContext._gateway

    def total():
        sc.listenerBus().waitUntilEmpty(30_000)
        stages = sc.statusStore().stageList(None, False, False, jvm.new_array(jvm.jvm.double, 0), jvm.jvm.java.util.ArrayList())
        return sum(stages.apply(i).shuffleWriteRecords() for i in range(stages.size()))

    before = total()
    run()
    return total() - before


def test_runs_are_shuffled_once_and_copies_are_not_paired_run_by_run(spark):
    copies = " ".join(f"{a}{b}" for a in "abcdefghijklmnopqrst" for b in "abcdefghijklmnopqrst")  # 396 runs
    frequent = " ".join("uvwxyz" * 2)
    rows = [(i, f"{copies} {'zz' * (i + 1)}") for i in range(12)] + [(100 + i, f"{frequent} {'y' * (i + 2)} one") for i in range(30)] + [(200, None), (201, "one two")]
    docs = spark.createDataFrame(rows, "k int, text string").repartition(4)
    got: dict = {}
    records = shuffled_records(spark, lambda: got.update({r["k"]: (r["twin"], r["n_shared"], r["n_rare"]) for r in similar.near_duplicates(docs, docs, "k", "k", "text").collect()}))
    assert got == {i: (0 if i else 1, 396, 397) for i in range(12)}
    assert records < 2 * 12 * 397


def test_terms_are_those_of_a_plain_count_and_rare_pairs_are_not_counted(spark, monkeypatch):
    rng = np.random.default_rng(5)
    vocabulary = [f"{a}{b}{c}" for a in "bcdfg" for b in "aeiou" for c in "klmnp"]
    texts = [(g, " ".join(rng.choice(vocabulary[25 * g : 25 * g + 100], 400, p=(w := 1 / np.arange(1, 101)) / w.sum()))) for g in (0, 1) for _ in range(15)]
    rows = [*texts, (0, "lion dance " * 300), (2, "one word. lion"), (2, None), (3, ""), (None, "bak lion dance bak")]
    docs = spark.createDataFrame(rows, "g int, text string").repartition(4)
    counts = Counter((r["g"], r["term"]) for r in docs.select("g", F.explode(terms.terms(F.col("text"))).alias("term")).collect())
    in_group, corpus = Counter(), Counter()
    for (g, term), k in counts.items():
        in_group[g] += k
        corpus[term] += k
    mean = sum(in_group.values()) / len(in_group)
    want = {}
    for g in (0, 1, 2):
        scores = sorted((-round(k / in_group[g] * math.log1p(mean / corpus[t]), 9), t, k) for (h, t), k in counts.items() if h == g)
        want |= {(g, i + 1): (t, k) for i, (_, t, k) in enumerate(scores[:8])}
    assert "lion dance" in {t for t, _ in want.values()}

    def found():
        return {(r["g"], r["rank"]): (r["term"], r["n_term"]) for r in terms.top_terms(docs, "g", "text").collect()}

    got: dict = {}
    records = shuffled_records(spark, lambda: got.update(found()))
    assert got == want and records < len(counts)
    monkeypatch.setattr(terms, "MOST_WORDS", 0)  # as where too many words are left
    assert found() == want


def test_vietnamese_letters_in_both_cases(spark):
    letters = spark.range(1, 0x11000).filter("id < 55296 or id > 57343").select("id", F.expr("decode(unhex(lpad(hex(id), 8, '0')), 'UTF-32')").alias("c"))
    one = F.repeat("c", F.lit(text.VIETNAMESE_LETTERS))
    assert letters.filter(text.is_vietnamese(one) != one.rlike(f"(?iu)[{text.VIETNAMESE}]")).count() == 0
    assert letters.filter(text.is_vietnamese(one)).count() == 104


def test_texts_stay_out_of_the_zones_windows(spark):
    signed = "Can you come on Sunday?\nBest,\nAnn Lee\nann@example.org 555-010-0199"
    rows = [(i, "A long text. " * 2000, []) for i in range(20)] + [(20, signed, [(signed.index("ann@"), signed.index(" 555"), "EMAIL_ADDRESS"), (signed.index("555"), len(signed), "PHONE_NUMBER")]), (21, None, None)]
    df = spark.createDataFrame(rows, "n int, text string, marked array<struct<start:int,end:int,entity_type:string>>").repartition(4)
    got: dict = {}
    records = shuffled_records(spark, lambda: got.update({r["n"]: (r["text"], r["zone"]) for r in with_zone(df, "text", F.col("marked")).collect()}))
    assert {n: (t, z and tuple(z)) for n, (t, z) in got.items()} == {n: (t, (signed.index("Best"), len(signed)) if n == 20 else None) for n, t, _ in rows}
    assert records <= 22 + 4 + 2 + 1  # all rows dealt to four, then the lines, spans and row of the one with spans


def test_leaking_terms_are_looked_for_plainly_before_their_pattern(spark):
    texts = ["at Sunny Acres, today", "sunny acreś", "sunný sunny acres", "sunny acres2", "_sunny acres", "sunny  acres", "<SUNNY> acres", "sunny (acres) sunny a.cres", None]
    docs = spark.createDataFrame(list(enumerate(texts)), "k int, text string")
    leaks = seeding.leaking(spark.createDataFrame([("sunny acres",), ("a.cres",), ("none here",)], "term string"), "term", docs, "k", "text")
    assert sorted(map(tuple, leaks.collect())) == [("a.cres", 1), ("sunny acres", 3)]
    plan = leaks._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Contains(") < plan.index("RLIKE")
