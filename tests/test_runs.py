"""Whole runs: shards written and read back, reports and lists, the redaction gate, held-out checks, descriptions."""

import json
import stat

import numpy as np
import pytest
from pyspark.sql import functions as F

from askmine.functions import recognizers
from askmine.operators import backfill, describe, embedding, gate, holdout, reports, seeding
from askmine.sources import files, mbox, shards


def emails(spark, n=45):
    rows = [(f"<m{i}@x>", str(i % 7), "2027-01-01T00:00:00+00:00", "inbound", ["Inbox"], "Ann <ann@x.org>", "ann@x.org", False, "us@x.org", f"s{i}", f"Call me, {i} times, at 714-555-01{i:02d}", 7, "text/plain", 0, [], i) for i in range(n)]
    return spark.createDataFrame(rows, shards.EMAIL)


def test_shards_read_back(spark, tmp_path):
    df = emails(spark)
    shards.write_shards(df, str(tmp_path / "out"), "offset", 20)
    assert sorted(p.name for p in (tmp_path / "out").glob("*")) == ["emails-00000.jsonl", "emails-00001.jsonl", "emails-00002.jsonl"]
    back = shards.read_shards(spark, str(tmp_path / "out"))
    assert sorted(map(str, back.drop("shard").collect())) == sorted(map(str, df.collect()))
    assert {r["shard"]: r["count"] for r in back.groupBy("shard").count().collect()} == {"emails-00000": 20, "emails-00001": 20, "emails-00002": 5}
    first = [json.loads(x)["offset"] for x in (tmp_path / "out" / "emails-00000.jsonl").read_text().splitlines()]
    assert first == list(range(20))


def test_key_position_and_seen_log(spark, tmp_path):
    path = tmp_path / "keys" / "hmac"
    key = shards.load_key(str(path))
    assert len(key) == 64 and shards.load_key(str(path)) == key and stat.S_IMODE(path.stat().st_mode) == 0o600
    position = shards.Position(str(tmp_path / "at.json"))
    assert position.load() == {}
    position.save(shard="emails-00001", row=7)
    assert position.load() == {"shard": "emails-00001", "row": 7}
    (tmp_path / "at.json").write_text("{torn")
    assert position.load() == {}
    position.clear()
    df = spark.createDataFrame([("a", "x"), ("b", "y"), ("", "z")], "id string, print string")
    log = str(tmp_path / "seen")
    c = F.col
    assert {r["drop_reason"] for r in shards.unseen(df, c("id"), c("print"), log).collect()} == {None}
    shards.remember_seen(df, c("id"), c("print"), log)
    later = spark.createDataFrame([("a", "n"), ("c", "y"), ("", "q"), ("d", "w")], "id string, print string")
    assert {r["id"]: r["drop_reason"] for r in shards.unseen(later, c("id"), c("print"), log).collect()} == {"a": "dup_id", "c": "dup_body", "": None, "d": None}


def test_mailbox_folders(spark, tmp_path):
    one = b"From 1@xxx Mon\nMessage-ID: <%d>\nFrom: Ann <a@b.co>\n\nHello there\n\n"
    for i in range(3):
        (tmp_path / f"{i}.mbox").write_bytes(one % i)
    (tmp_path / "note.txt").write_text("no mailbox")
    spark.dataSource.register(mbox.MboxSource)
    for path in (str(tmp_path), f"file://{tmp_path}"):
        assert {r["id"] for r in spark.read.format("mbox").load(path).collect()} == {"<0>", "<1>", "<2>"}


def reviewed(spark, df):
    rows = [(r["id"], r["thrid"], "body", "PHONE_NUMBER", r["body"].index("714"), r["body"].index("714") + 12, r["body"][r["body"].index("714") :], "", 0.8, "loose_phone", "redact", "default", "") for r in df.collect()]
    return spark.createDataFrame(rows, shards.REVIEW)


def test_gate_writes_only_clean_shards(spark, tmp_path):
    df = emails(spark)
    where = {k: str(tmp_path / k) for k in ("emails", "reviews", "originals", "views", "out")}
    shards.write_shards(df, where["emails"], "offset", 20)
    with_shard = shards.read_shards(spark, where["emails"])
    review = reviewed(spark, df).join(with_shard.select(F.col("id").alias("email_id"), "shard"), "email_id")
    files.write_lines(reports.views(with_shard, review), where["views"])
    assert "[PHONE_NUMBER: 714-555-0107]" in (tmp_path / "views" / "emails-00000.txt").read_text()
    for kind in ("reviews", "originals"):
        for shard in ("emails-00000", "emails-00001"):  # nobody has reviewed the third
            own = review.filter(F.col("shard") == shard).drop("shard").toPandas()
            (tmp_path / kind).mkdir(exist_ok=True)
            if kind == "reviews" and shard == "emails-00001":
                own = own.iloc[1:]  # a row was deleted
            own.to_csv(tmp_path / kind / f"{shard}.csv", index=False)
    wrong = gate.run(spark, **where, key_file=str(tmp_path / "key")).collect()
    assert {(r["problem"], r["shard"]) for r in wrong} == {("deleted_row", "emails-00001")}
    assert [p.name for p in (tmp_path / "out").glob("*")] == ["emails-00000.jsonl"]
    rows = [json.loads(x) for x in (tmp_path / "out" / "emails-00000.jsonl").read_text().splitlines()]
    assert len(rows) == 20 and rows[3]["body"] == "Call me, 3 times, at <PHONE_NUMBER>" and len(rows[3]["id"]) == 16 and "from" not in rows[3]
    assert gate.analyzed(spark, where["views"]).count() == 45
    assert shards.unedited(spark, where["originals"], where["originals"]) and not shards.unedited(spark, where["reviews"], where["originals"]) and not shards.unedited(spark, where["reviews"], str(tmp_path / "none"))


def test_held_out_ids_must_not_leak(spark, tmp_path):
    ids = spark.createDataFrame([("0123456789abcdef",)], "id string")
    (tmp_path / "a" / "b").mkdir(parents=True)
    (tmp_path / "a" / "b" / "x.txt").write_text("nothing\nhere 0123456789abcde")
    holdout.check(spark, str(tmp_path), ids)
    (tmp_path / "a" / "y.json").write_text('{"id": "0123456789abcdef"}')
    with pytest.raises(holdout.Leak, match="y.json: 1"):
        holdout.check(spark, str(tmp_path), ids)


def chunks(spark):
    rng = np.random.default_rng(3)
    rows, out = [], []
    for c in range(3):
        centre = rng.normal(size=8)
        for i in range(6):
            text = f"question {['lions', 'drums', 'dates'][c]} number{min(i, 4)}"  # the last two say the same
            rows.append((f"c{c}{i}", f"e{c}{i}", f"t{c}{i % 5}", f"2027-01-0{1 + i}T10:00:00+00:00", 0, text, (centre + 0.1 * rng.normal(size=8)).tolist(), c))
            out.append((f"r{c}{i}", f"o{c}{i}", f"t{c}{i % 5}", f"2027-01-0{1 + i}T1{i % 3}:00:00+00:00", 0, f"Answer {i % 2}"))
    rows.append(("noise", "e", "t", "2027-01-01T10:00:00+00:00", 0, "noise", [0.0] * 8, -1))
    head = "chunk_id string, id string, thrid string, date string, chunk_index int, text string"
    return spark.createDataFrame(rows, head + ", embedding array<double>, cluster int"), spark.createDataFrame(out, head)


def test_descriptions(spark, tmp_path):
    asked, answered = chunks(spark)
    got = {r["cluster"]: r for r in describe.described(asked, answered).collect()}
    assert set(got) == {0, 1, 2}
    rows, replies = asked.collect(), answered.collect()
    for c, r in got.items():
        own = [x for x in rows if x["cluster"] == c]
        assert (r["n_chunks"], r["n_emails"], r["n_threads"]) == (6, 6, 5) and r["top_terms"].startswith(["lions", "drums", "dates"][c])
        once = {}
        for x in sorted(own, key=lambda x: x["chunk_id"]):
            once.setdefault(x["text"], x)
        mean = np.mean([x["embedding"] for x in once.values()], 0)
        best = sorted(once.values(), key=lambda x: (-round(float(np.dot(x["embedding"], mean)), 9), x["chunk_id"]))[:5]
        assert r["representatives"].split() == [x["chunk_id"] for x in best]
        expected, texts = [], set()
        for x in best:
            later = sorted((y["date"], y["chunk_index"], y["chunk_id"], y["text"]) for y in replies if y["thrid"] == x["thrid"] and y["date"] > x["date"])
            if later and later[0][3] not in texts and len(expected) < 2:
                texts.add(later[0][3])
                expected.append(later[0][2])
        assert r["replies"].split() == expected
    summaries = describe.described(asked, answered)
    texts = describe.with_texts(summaries, asked)
    triaged = summaries.select("cluster", F.col("n_chunks").alias("n"), "top_terms", F.when(F.col("cluster") == 1, "faq").otherwise("skip").alias("decision"), F.lit("").alias("reason"))
    points = spark.range(100).select((F.rand(1) * 2 - 1).alias("x"), (F.rand(2) * 2 - 1).alias("y"), (F.col("id") % 4 - 1).cast("int").alias("cluster"))
    for made in (reports.report(summaries, texts), reports.triage(triaged), reports.candidates(summaries, triaged, texts), reports.table(summaries, ["cluster"], "clusters.tsv"), reports.page(summaries, points), reports.read_by_hand(asked, describe.next_replies(asked, answered))):
        files.write_lines(made, str(tmp_path / "r"))
    text = (tmp_path / "r" / "report.txt").read_text()
    assert text.index("cluster 0: 6 chunks") < text.index("cluster 2: 6 chunks") and text.count("  - question") == 15
    assert (tmp_path / "r" / "triage.txt").read_text().splitlines()[0].startswith("faq\tcluster 1")
    assert "cluster 1:" in (tmp_path / "r" / "candidates.txt").read_text() and "cluster 0:" not in (tmp_path / "r" / "candidates.txt").read_text()
    assert (tmp_path / "r" / "clusters.tsv").read_text().splitlines()[0].split("\t")[:2] == ["cluster", "n_chunks"]
    page = (tmp_path / "r" / "clusters.html").read_text()
    assert page.startswith("<!doctype html>") and page.count("<tr><td>") == 3 and "<circle" in page and "question" not in page.replace("question", "", page.count("; question") + page.count("<td>question") + page.count(" question"))
    assert "=== t00" in (tmp_path / "r" / "read_by_hand-2027-01.txt").read_text()


def test_lists(spark, tmp_path):
    english = tmp_path / "words"
    english.write_text("mission\nJune\nvan\n")
    words = shards.english_words(spark, str(english))
    assert {r["word"] for r in words.collect()} == {"mission", "van"}
    mails = spark.createDataFrame([("a", "Irvine  and mission viejo", "We met in Irvine. irvine@x.org, the Mission near Mission Viejo"), ("b", "", "mt. sac, not mt.sacs; Irvine")], "id string, subject string, body string")
    spans = [("a", "subject", 0, 6, "Irvine"), ("a", "body", 10, 16, "Irvine"), ("b", "body", 0, 7, "mt. sac"), ("a", "subject", 12, 25, "Mission Viejo"), ("a", "body", 36, 43, "Mission")]
    review = spark.createDataFrame([(i, f, "LOCATION", seeding.VOTER, a, b, t) for i, f, a, b, t in spans], "email_id string, field string, entity_type string, recognizer string, start int, end int, text string")
    votes = {r["term"]: (r["mentions"], r["tagged"]) for r in seeding.place_votes(mails, review).collect()}
    assert votes == {"irvine": (3, 2), "mission viejo": (2, 1), "mt. sac": (1, 1), "mission": (1, 1)}
    chosen = spark.createDataFrame([("mission", 3, 2), ("mission viejo", 2, 1)], "term string, mentions long, tagged long")
    places = seeding.split_places(chosen, words)
    names = seeding.split_names(spark.createDataFrame([("Van", 2), ("Nguyen", 1)], "part string, n long"), words)
    files.write_lines(reports.word_list(places.select("section", "entry").unionByName(names.select("section", "entry")), "lists.txt"), str(tmp_path / "l"))
    lists = recognizers.read_lists(spark, str(tmp_path / "l" / "lists.txt"))
    assert {(r["section"], r["entry"]) for r in lists.collect()} == {("places", "mission viejo"), ("capitalized", "Mission"), ("ambiguous", "Van"), ("names", "Nguyen")}
    known = recognizers.from_lists(lists)
    said = "Van saw the Mission and NGUYEN"
    found = {(said[a:b], r) for a, b, _, _, r in recognizers.scan(said, known)}
    assert {("Van", "denylist_ambiguous"), ("Mission", "denylist_places_capitalized"), ("NGUYEN", "denylist_names")} <= found
    parse = lambda text: [(0, 3, "VERB", "")]
    assert [s for _, _, _, s, r in recognizers.scan("Van saw", known, parser=parse) if r == "denylist_ambiguous"] == [recognizers.ORDINARY]
    assert recognizers.read_lists(spark, str(tmp_path / "missing")).count() == 0


def test_units_and_long_words(spark):
    rows = spark.createDataFrame([([3.0, 4.0],), ([0.0, 0.0],), ([1.0, 0.00001],)], "v array<float>").select(embedding.unit(F.col("v")).alias("u")).collect()
    assert np.allclose([list(r["u"]) for r in rows], [[0.6, 0.8], [0, 0], [1, 0.00001]])
    one, many = embedding.HashedTerms(16)(["a b b"]), embedding.HashedTerms(16)(["", "a b b", "c"])
    assert many[1] == one[0] and many[0] == [0.0] * 16
    assert backfill.covered(1, 5, [(0, 3), (3, 6)]) and not backfill.covered(1, 5, [(0, 3), (4, 6)])


def test_density_of_copies_and_widths(spark):
    from askmine.operators import density

    rng = np.random.default_rng(12)
    centres = rng.normal(size=(8, 12)) * 3
    points = np.vstack([c + 0.15 * rng.normal(size=(60 + 20 * i, 12)) for i, c in enumerate(centres)])
    truth = np.repeat(np.arange(8), [60 + 20 * i for i in range(8)])
    rows = [(i, p.tolist()) for i, p in enumerate(points)] + [(10_000 + j, points[0].tolist()) for j in range(400)]  # a third are copies of one
    df = spark.createDataFrame(rows, "id long, v array<double>").repartition(3)
    whole = {r["id"]: r["cluster"] for r in density.clustered(df, "id", "v").collect()}
    assert len(whole) == len(rows) and len({whole[i] for i in range(len(points))} - {-1}) == 8
    assert {whole[10_000 + j] for j in range(400)} == {whole[0]} and whole[0] == 0  # with its copies the largest
    best = [np.unique([whole[i] for i in np.flatnonzero(truth == c)], return_counts=True) for c in range(8)]
    assert np.mean([n.max() / n.sum() for _, n in best]) > 0.95 and len({k[n.argmax()] for k, n in best}) == 8
    flat = density.mapped(df, "id", "v").collect()
    assert len(flat) == len(rows) and all(-1 <= r["x"] <= 1 and -1 <= r["y"] <= 1 for r in flat)
    with pytest.raises(ValueError, match="one width"):
        density.clustered(spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0])], "id long, v array<double>"), "id", "v")
