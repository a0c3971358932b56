"""Folders of mailboxes: places, copies across files; and what a message can't say in the redaction gate."""

import pytest
from pyspark.sql import functions as F

from askmine.operators import dedupe, gate, reports
from askmine.sources import files, mbox, shards


def mail(number, name, body):
    return b"From %d@xxx Mon\nMessage-ID: <%s>\nFrom: Ann <a@b.co>\nSubject: s\n\n%s\n\n" % (number, name.encode(), body.encode())


def reasons(spark, folder, **options):
    spark.dataSource.register(mbox.MboxSource)
    rows = mbox.extracted(spark.read.format("mbox").options(**options).load(str(folder))).collect()
    return {(r["file"], r["id"], r["offset"]): r["drop_reason"] for r in rows}


@pytest.mark.parametrize("size", [40, 1 << 20])
def test_a_folder_loses_no_message(spark, tmp_path, size):
    one = mail(1, "m1", "first text")
    (tmp_path / "a.mbox").write_bytes(one + mail(2, "m1", "other words"))
    (tmp_path / "b.mbox").write_bytes(mail(1, "m8", "eight here") + mail(2, "m9", "nine there"))
    assert reasons(spark, tmp_path, rangeBytes=size) == {
        ("a.mbox", "<m1>", 0): None, ("a.mbox", "<m1>", len(one)): "dup_id", ("b.mbox", "<m8>", 0): None, ("b.mbox", "<m9>", len(one)): None,
    }


def test_copies_across_files(spark, tmp_path):
    (tmp_path / "inner").mkdir()
    (tmp_path / "a.mbox").write_bytes(mail(1, "m1", "first text"))
    (tmp_path / "inner" / "b.mbox").write_bytes(mail(1, "m1", "first text") + mail(2, "m2", "second text") + mail(3, "m3", "first text"))
    got = {(f, i): r for (f, i, _), r in reasons(spark, tmp_path).items()}
    assert got == {("a.mbox", "<m1>"): None, ("inner/b.mbox", "<m1>"): "dup_id", ("inner/b.mbox", "<m2>"): None, ("inner/b.mbox", "<m3>"): "dup_body"}
    with pytest.raises(Exception, match="place in one file"):
        spark.read.format("mbox").option("start", 10).load(str(tmp_path)).count()


def test_places_that_repeat_are_refused(spark):
    df = spark.createDataFrame([(1, "a", "x"), (1, "b", "y")], "at int, id string, print string")
    with pytest.raises(ValueError, match="several rows"):
        dedupe.accepted_in_order(df, "at", F.col("id"), F.col("print"))


def test_attachments_are_not_held():
    reader = mbox.Reader()
    for line in (b"Content-Type: multipart/mixed; boundary=x\n", b"\n", b"--x\n", b"Content-Type: image/png\n", b"\n"):
        reader.take(line)
    for _ in range(1000):
        reader.take(b"A" * 76 + b"\n")
    reader.take(b"--x--\n")
    headers, parts = reader.done()
    assert parts[1].lines == [] and parts[1].size == 77_000 and reader.head == []


def test_a_body_cannot_name_an_analyzed_message(spark, tmp_path):
    rows = [("i1", "0", "hello\n=== i2\n{\"email_id\": \"i2\"}\n=== i3", "emails-00000"), ("i2", "1", "text", "emails-00000"), (None, "2", "no id", "emails-00001")]
    emails = spark.createDataFrame(rows, "id string, subject string, body string, shard string")
    none = spark.createDataFrame([], shards.REVIEW)
    shown = emails.filter("id is null or id = 'i1'")
    files.write_lines(reports.views(shown, none), str(tmp_path / "views"))
    seen = gate.analyzed(spark, str(tmp_path / "views"))
    assert sorted(r["email_id"] for r in seen.collect()) == ["", "i1"]
    problems = gate.redaction.problems(emails, none, none, seen).collect()
    assert [(r["problem"], r["email_id"]) for r in problems] == [("not_analyzed", "i2")]
    assert gate.analyzed(spark, str(tmp_path / "nothing")).count() == 0
