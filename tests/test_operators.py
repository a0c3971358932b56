import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from askmine.operators import backfill, clusters, dedupe, density, embedding, redaction, seeding, similar, spans, terms, threads
from askmine.functions.recognizers import recognizers
from askmine.sources import mbox, shards
from askmine.streaming.shards import process_new_shards
from tests.plain_density import hdbscan


def test_order_dependent_dedupe_is_the_plain_scan(spark):
    rng = np.random.default_rng(5)
    rows = [(i, rng.choice(["", "a", "b", "c", "d", f"u{i}"]), f"p{rng.integers(0, 25)}") for i in range(120)]
    rows += [(200, "A", "f1"), (201, "B", "f1"), (202, "B", "f3"), (203, None, "f9"), (204, None, "f9")]
    df = spark.createDataFrame(rows, "at long, id string, print string")
    got = {r["at"]: r["drop_reason"] for r in dedupe.accepted_in_order(df, "at", F.col("id"), F.col("print")).collect()}
    expected = dict(zip([r[0] for r in rows], dedupe.scan_in_order(pd.DataFrame([r[1:] for r in rows]))))
    assert got == expected and got[202] is None


def test_first_of_equal_texts(spark):
    df = spark.createDataFrame([(3, "A  b"), (1, "a b"), (2, None), (4, "c")], "k long, text string")
    got = {r["k"]: r["first_key"] for r in dedupe.first_of_equal_texts(df, "k", "text").collect()}
    assert got == {3: 1, 1: 1, 2: 2, 4: 4}


def test_touching_intervals_stay_apart(spark):
    df = spark.createDataFrame([("x", 0, 5), ("x", 3, 8), ("x", 8, 9), ("y", 0, 1)], "g string, a int, b int")
    got = sorted(map(tuple, dedupe.merged_intervals(df, ["g"], "a", "b").collect()))
    assert got == [("x", 0, 8, 2), ("x", 8, 9, 1), ("y", 0, 1, 1)]


def test_first_reply_across_time_zones(spark):
    rows = [("t", "2027-01-01T10:00:00-08:00", "in", 0), ("t", "2027-01-01T17:59:59+00:00", "out", 1), ("t", "2027-01-01T18:00:01+00:00", "out", 2), ("t", None, "out", 3)]
    df = spark.createDataFrame(rows, "thrid string, date string, d string, n int").withColumn("ts", F.try_to_timestamp("date"))
    got = threads.with_first_reply(df, "thrid", "ts", "n", F.col("d") == "in", F.col("d") == "out").first()
    assert got["reply"]["position"] == 2


def test_first_client_message_reasons(spark):
    row = lambda n, thrid, minute, direction, sender, subject, body: (n, thrid, minute and f"2027-01-01T00:{minute:02d}:00+00:00", direction, sender, subject, body)
    rows = [
        row("1", "ok", 1, "inbound", "c", "Lions", "Can you bring lions?"), row("2", "reply", 1, "inbound", "c", "Re: Lions", "Can you bring lions?"),
        row("3", "auto", 1, "inbound", "c", "Out of office", "I am away now"), row("4", "wire", 1, "inbound", "c", "x", "call 714-555-0100 now please"),
        row("5", "none", 1, "inbound", "us", "x", "a draft of our own"), row("6", "late", 1, "outbound", "us", "x", "hello there you"), row("7", "late", 2, "inbound", "c", "x", "yes please do come"),
        row("8", "undated", None, "inbound", "c", "x", "Can you bring lions?"), row("9", "empty", 1, "inbound", "c", "x", "Thanks <PERSON>!"),
    ]
    df = spark.createDataFrame(rows, "id string, thrid string, date string, direction string, sender string, subject string, body string")
    got = {r["thrid"]: (r["reason"], r["kind"]) for r in threads.first_client_message(df, df.filter("direction = 'outbound'")).collect()}
    assert got["ok"] == ("", "opener") and got["late"] == ("", "follow_up")
    assert {k: v[0] for k, v in got.items() if v[0]} == {"reply": "reply", "auto": "auto_reply", "wire": "tripwire", "none": "no_client_email", "undated": "undated", "empty": "no_content"}


def test_near_duplicates(spark):
    shared = " ".join(chr(97 + i) * 2 for i in range(13))
    rows = [("q", "t1", shared + " zz"), ("p", "t2", shared + " yy"), ("o", "t1", shared + " zz"), ("n", "t3", "nothing of the sort is here")]
    df = spark.createDataFrame(rows, "id string, t string, text string")
    got = {r["id"]: (r["twin"], r["n_shared"], r["n_rare"]) for r in similar.near_duplicates(df, df, "id", "t", "text").collect()}
    assert got["q"] == ("p", 9, 10) and got["p"] == ("o", 9, 10) and "n" not in got


def test_terms_and_markup(spark):
    df = spark.createDataFrame([(0, "the lion dances. lion dance!"), (1, "div style font face and the drum"), (1, "drum drum")], "g int, text string")
    top = terms.top_terms(df, "g", "text")
    assert top.filter("g = 0 and rank = 1").first()["term"] == "lion"
    signals = {r["g"]: r for r in clusters.triaged(clusters.signals(df, "g", "text", top)).collect()}
    assert signals[1]["markup_terms"] >= 3 and signals[1]["reason"] == "markup"


def test_ranks_and_representatives(spark):
    df = spark.createDataFrame([(c,) for c in [7] * 3 + [3] * 3 + [1] + [-1] * 5], "c int")
    assert {r["c"]: r["new_cluster"] for r in clusters.ranked_by_size(df, "c").collect()} == {3: 0, 7: 1, 1: 2, -1: -1}
    vectors = spark.createDataFrame([(0, 0, [1.0, 0.0]), (1, 0, [0.8, 0.6]), (2, 0, [0.0, 1.0])], "k int, c int, v array<double>")
    assert [r["k"] for r in clusters.representatives(vectors, "k", "c", "v", 2).orderBy("rank").collect()] == [1, 0]


def test_planted_topics_are_found():
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(5, 8)) * 3
    points = np.concatenate([c + 0.3 * rng.normal(size=(40, 8)) for c in centres] + [rng.normal(size=(20, 8)) * 6])
    labels, strength = hdbscan(points)
    for k in range(5):
        own = labels[40 * k : 40 * k + 40]
        assert (own == np.bincount(own[own >= 0]).argmax()).mean() >= 0.9
    assert len({labels[40 * k] for k in range(5)}) == 5 and (labels[200:] == -1).mean() > 0.5
    assert ((strength >= 0) & (strength <= 1)).all() and np.array_equal(labels, hdbscan(points)[0])
    assert len(density.SWEEP) == 16


def test_clusters_in_spark_label_every_row(spark):
    rng = np.random.default_rng(2)
    rows = [(i, (np.eye(8)[i % 2] + 0.05 * rng.normal(size=8)).tolist()) for i in range(120)]
    df = spark.createDataFrame(rows, "k long, v array<double>")
    for method in ("eom", "leaf"):
        got = {r["k"]: r["cluster"] for r in density.clustered(df, "k", "v", method=method).collect()}
        assert len(got) == 120 and len({got[k] for k in got if got[k] >= 0}) == 2


def test_embedding_filters_numbers_and_resplits(spark):
    row = lambda i, thrid, body, direction="inbound", sender="c": (i, thrid, None, direction, sender, "", body)
    rows = [row("a", "t1", "Can you bring two lions"), row("b", "t1", " ".join(f"w{i}" for i in range(650))), row("c", "t1", "call 714-555-0100 please now"), row("d", "t20", "held out thread of ours"), row("e", "t1", "our own draft here", sender="us"), row("f", "t1", "a sent answer of ours", "outbound", "us")]
    df = spark.createDataFrame(rows, "id string, thrid string, date string, direction string, sender string, subject string, body string")
    got = embedding.embedded(df).collect()
    assert sorted({r["id"] for r in got}) == ["a", "f"] or sorted({r["id"] for r in got}) == ["a", "b", "f"]
    reasons = {r["id"]: r["skip_reason"] for r in embedding.with_skip_reason(df).collect()}
    assert reasons == {"a": None, "b": None, "c": "quarantined", "d": "held_out", "e": "own_unsent", "f": None}
    assert [tuple(r)[1:3] for r in embedding.quarantine(df).collect()] == [("body", "PHONE_NUMBER")]
    assert all(abs(sum(x * x for x in r["embedding"]) - 1) < 1e-3 for r in got)

    def small(texts):
        if any(len(x.split()) > 2 for x in texts):
            raise embedding.TooLong
        return [[1.0] for _ in texts]

    assert [[p for p, _ in pairs] for pairs in embedding.vectors_of(["a b c d e", "f"], small)] == [["a b", "c", "d e"], ["f"]] or [" ".join(p for p, _ in pairs) for pairs in embedding.vectors_of(["a b c d e", "f"], small)] == ["a b c d e", "f"]
    with pytest.raises(embedding.TooLong):
        embedding.vectors_of(["x"], lambda texts: (_ for _ in ()).throw(embedding.TooLong()))


def emails(spark, *rows):
    return spark.createDataFrame([(i, "t", s, b) for i, s, b in rows], "id string, thrid string, subject string, body string")


def test_flag_and_redact(spark):
    df = emails(spark, ("m1", "Order #12345", "Call 714-555-0100 by 10/22/2027.​"), ("m2", "Hi", "nothing"))
    review = spans.flagged(df)
    rows = {(r["email_id"], r["field"], r["entity_type"]): r for r in review.collect()}
    assert ("m1", "subject", "ORDER_ID") in rows and rows[("m1", "body", "PHONE_NUMBER")]["decision"] == "redact"
    assert "[[714-555-0100]]" in rows[("m1", "body", "PHONE_NUMBER")]["context"]
    done = {r["id"]: r for r in redaction.redact(df, review).collect()}
    assert done["m1"]["body"].startswith("Call <PHONE_NUMBER> by") and done["m1"]["subject"] == "Order #<ORDER_ID>"
    assert done["m2"]["n_redacted"] == 0 and done["m2"]["body"] == "nothing"
    hashed = redaction.redact(df, review, b"key").first()
    assert len(hashed["id"]) == 16


def test_redaction_of_stale_offsets_and_overlaps():
    span = lambda a, b, text, e="PERSON": {"start": a, "end": b, "text": text, "entity_type": e}
    assert redaction.redact_text("Ann met Ann", [span(5, 8, "Ann")]) == ("<PERSON> met <PERSON>", 2, 0, 0)
    assert redaction.redact_text("no one", [span(0, 3, "Ann")]) == ("no one", 0, 1, 0)
    assert redaction.redact_text("abcdef", [span(0, 4, "abcd"), span(2, 6, "cdef", "URL"), span(0, 2, "ab")])[0] == "<PERSON><URL>"
    assert redaction.redact_text("Hi\n\n\n\nBest\nAnn", [span(6, 14, "Best\nAnn", "SIGNATURE"), span(11, 14, "Ann")])[0] == "Hi"


def test_review_problems(spark):
    df = emails(spark, ("m1", "", "x"), ("m2", "", "y"))
    make = lambda *rows: spark.createDataFrame(list(rows), "email_id string, field string, start int, end int, decision string")
    original = make(("m1", "body", 0, 1, "redact"), ("m1", "body", 0, 1, "redact"))
    review = make(("m1", "body", 0, 1, "maybe"), ("m9", "body", 0, 1, "keep"))
    got = sorted(map(tuple, redaction.problems(df, review, original, spark.createDataFrame([("m1",)], "email_id string")).collect()))
    assert got == [("deleted_row", "m1"), ("not_analyzed", "m2"), ("unknown_decision", "m1"), ("unknown_email", "m9")]


def test_backfill_is_idempotent(spark):
    df = emails(spark, ("m1", "", "at Sunny Acres and White Palace Ballroom"))
    known = recognizers(venues=["Sunny Acres", "White Palace", "Palace Ballroom"])[:1]
    empty = spark.createDataFrame([], "email_id string, field string, entity_type string, start int, end int, text string, score double, recognizer string, decision string, rule string, note string")
    new = backfill.new_spans(df, empty, known)
    assert sorted(r["text"] for r in new.collect()) == ["Palace Ballroom", "Sunny Acres", "White Palace"]
    assert backfill.new_spans(df, new, known).count() == 0
    assert backfill.covered(0, 5, [(3, 6), (0, 3)]) and not backfill.covered(0, 5, [(0, 3), (4, 6)])


def test_seeding(spark):
    df = spark.createDataFrame([("Trần Thảo <a@x.org>", "b@x.org"), ("Nguyen, Thao <c@x.org>", ""), ("Bob Stone <d@x.org>", None)], "`from` string, `to` string")
    counts = {r["part"]: r["n"] for r in seeding.name_harvest(df, ["Tran", "Le"]).collect()}
    assert counts == {"Trần": 1, "Tran": 1, "Thảo": 1, "Thao": 1, "Le": 0}
    mail = emails(spark, ("m1", "", "We live in Irvine. irvine is nice"), ("m2", "", "see irvine"))
    votes = spark.createDataFrame([("m1", "body", "LOCATION", seeding.VOTER, 11, 17, "Irvine"), ("m2", "body", "LOCATION", seeding.VOTER, 4, 10, "irvine")], "email_id string, field string, entity_type string, recognizer string, start int, end int, text string")
    tally = seeding.place_votes(mail, votes)
    assert [tuple(r) for r in tally.collect()] == [("irvine", 3, 2)]
    assert seeding.selected_places(tally, []).count() == 1 and seeding.selected_places(tally, ["irvine"]).count() == 0
    venues = spark.createDataFrame([("Sunny Acres, Irvine",), ("sunny Acres",), ("12 Oak St",), ("backyard",)], "v string")
    assert [tuple(r) for r in seeding.venue_harvest(venues, "v", []).collect()] == [("sunny acres", "Sunny Acres", 2)]
    leaks = seeding.leaking(spark.createDataFrame([("sunny acres",)], "term string"), "term", mail.withColumn("body", F.lit("at Sunny Acres, <LOCATION>")), "id", "body")
    assert [tuple(r) for r in leaks.collect()] == [("sunny acres", 2)]
    english = spark.createDataFrame([("thao",)], "word string")
    split = {r["part"]: r["ambiguous"] for r in seeding.split_ambiguous(spark.createDataFrame([("Thao",), ("Le",)], "part string"), "part", english).collect()}
    assert split == {"Thao": True, "Le": False}


def test_review_sample_is_stable(spark):
    df = emails(spark, *[(f"m{i}", "", "x") for i in range(10)])
    review = spark.createDataFrame([(f"m{i}", "PERSON", "redact", "Ann") for i in range(4)], "email_id string, entity_type string, decision string, text string")
    one, two = (sorted(map(tuple, seeding.review_sample(df, review, 4, seed=3).collect())) for _ in range(2))
    assert one == two and len(one) == 4 and sum(r[1].startswith("top PERSON #1") for r in one) == 1


MAIL = b"""From 1@xxx Mon
X-Gmail-Labels: Inbox
Message-ID: <q1@x>
X-GM-THRID: 11
From: Ann <ann@example.com>
Subject: Lions
Date: Fri, 1 Jan 2027 10:00:00 -0800
Content-Type: multipart/mixed; boundary="b"

--b
Content-Type: text/plain; charset=utf-8
Content-Transfer-Encoding: quoted-printable

Do you have lions=3F
From 5 to 7 pm
--b
Content-Type: application/pdf; name="a.pdf"
Content-Transfer-Encoding: base64

QUJDREVGR0g=
--b--
epilogue

From 2@xxx Mon
X-Gmail-Labels: Sent
Message-ID: <a1@x>
From: us@example.org
Subject: Re: Lions

We do.

From 3@xxx Mon
X-Gmail-Labels: Spam
From: s@example.com

Buy

From 4@xxx Mon
From: news@example.com
List-Unsubscribe: <x>

News

From 5@xxx Mon
Message-ID: <q1@x>
From: ann@example.com
Content-Type: text/html

<p>Other &amp; text</p>

From 6@xxx Mon
Message-ID: <q2@x>
From: ann@example.com

> only quoted
"""


@pytest.mark.parametrize("size", [64, 300, 1 << 20])
def test_mailbox_by_any_ranges(spark, tmp_path, size):
    path = tmp_path / "all.mbox"
    path.write_bytes(MAIL)
    spark.dataSource.register(mbox.MboxSource)
    mail = spark.read.format("mbox").option("rangeBytes", size).load(str(path))
    rows = sorted(mbox.extracted(mail).collect(), key=lambda r: r["offset"])
    assert [r["drop_reason"] for r in rows] == [None, None, "dropped_label", "automated", "dup_id", "empty_body"]
    assert rows[0]["body"] == "Do you have lions?\nFrom 5 to 7 pm" and rows[0]["date"] == "2027-01-01T10:00:00-08:00"
    assert rows[0]["attachments"][0].asDict() == {"filename": "a.pdf", "content_type": "application/pdf", "approx_bytes": 9}
    assert [r["direction"] for r in rows[:2]] == ["inbound", "outbound"]
    assert all(a["end_offset"] == b["offset"] for a, b in zip(rows, rows[1:])) and rows[-1]["end_offset"] == len(MAIL)
    rest = spark.read.format("mbox").option("start", rows[2]["offset"]).load(str(path))
    assert sorted(r["offset"] for r in rest.collect()) == [r["offset"] for r in rows[2:]]


def test_shards_manifest_and_stream(spark, tmp_path):
    df = spark.range(45).select(F.col("id").alias("offset"), F.col("id").cast("string").alias("id"))
    numbers = {r["offset"]: r["shard"] for r in shards.with_shard(df, "offset", 20).collect()}
    assert numbers[0] == numbers[19] == "emails-00000" and numbers[20] == "emails-00001" and numbers[44] == "emails-00002"
    path = str(tmp_path / "run.json")
    shards.same_settings(path, {"seed": 1})
    shards.same_settings(path, {"seed": 1})
    with pytest.raises(ValueError):
        shards.same_settings(path, {"seed": 2})
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "emails-00000.jsonl").write_text('{"id": "a", "body": "x"}\n{"id": "b"}\n')
    run = lambda: process_new_shards(spark, str(folder), str(tmp_path / "out"), str(tmp_path / "done"), lambda b: b.select("id"))
    assert run() == 1 and run() == 0
    (folder / "emails-00001.jsonl").write_text('{"id": "c"}\n')
    assert run() == 1 and spark.read.parquet(str(tmp_path / "out")).count() == 3
    assert shards.read_shards(spark, str(folder), skip=["emails-00001"]).count() == 2
    review = spark.createDataFrame([("m", "t", "body", "X", 0, 1, 'a "b"\nc', "", 0.5, "r", "redact", "d", "")], shards.REVIEW)
    shards.write_review(review, str(tmp_path / "csv"))
    assert shards.read_review(spark, str(tmp_path / "csv")).first()["text"] == 'a "b"\nc'


def test_guards(spark):
    chunks = spark.createDataFrame([("a", "clustering", "m")], "chunk_id string, task string, model string")
    assert shards.one_kind(chunks) == "m"
    with pytest.raises(ValueError):
        shards.one_kind(chunks.union(spark.createDataFrame([("b", "clustering", "n")], chunks.schema)))
    with pytest.raises(ValueError):
        shards.refuse_stale(spark.createDataFrame([("z",)], "chunk_id string"), chunks)
