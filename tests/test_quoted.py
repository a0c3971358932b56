"""Quoted CSV by ranges of any size against Python's reader; lines of review rows in refusals."""

import csv
import io

import numpy as np
import pytest

from askmine.operators import gate
from askmine.sources import quoted, shards


def plain(text):
    reader, done, out = csv.reader(io.StringIO(text, newline="")), 0, []
    for fields in reader:
        if fields:
            out.append((done + 1, fields))
        done = reader.line_num
    return out


def sheet(rng, end):
    cells = ["", "a", "two\nlines", 'a "quote"', "x,y", "é\n\n\"\"", "end\r\nhere", "plain words", '"', "\n"]
    out = io.StringIO(newline="")
    writer = csv.writer(out, lineterminator=end)
    for _ in range(60):
        writer.writerow([cells[int(i)] for i in rng.integers(0, len(cells), 3)])
        if rng.random() < 0.1:
            out.write(end)
    text = out.getvalue()
    return text if rng.random() < 0.5 else text.rstrip("\r\n")


@pytest.mark.parametrize("size", [1, 2, 7, 64, 1000])
@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_records_of_any_ranges(tmp_path, size, end):
    rng = np.random.default_rng(size)
    text = sheet(rng, end)
    path = tmp_path / "a.csv"
    path.write_bytes(text.encode())
    data, got = text.encode(), []
    for _, start, stop in quoted.byte_ranges(str(path), size=size):
        before = data[:start]
        got += quoted.records(str(path), start, stop, bool(before.count(b'"') % 2), before.count(b"\n"))
    assert got == plain(text) and len(got) >= 60


def test_folders_in_spark(spark, tmp_path):
    rng = np.random.default_rng(0)
    texts = {f"{i}.csv": sheet(rng, "\n") for i in range(3)} | {"empty.csv": ""}
    for name, text in texts.items():
        (tmp_path / name).write_bytes(text.encode())
    (tmp_path / "other.txt").write_text("no sheet")
    rows = quoted.read(spark, str(tmp_path), size=200).collect()
    assert sorted((r["file"].rsplit("/")[-1], r["line"], r["fields"]) for r in rows) == sorted((n, line, fields) for n, t in texts.items() for line, fields in plain(t))
    assert quoted.read(spark, str(tmp_path / "none")).count() == 0


def test_refusals_name_the_line(spark, tmp_path):
    (tmp_path / "emails-00000.csv").write_text('email_id,field,start,end,text,decision\nm1,body,0,4,"Call\nme",redact\n\nm1,body,9,12,abc,perhaps\nm7,body,,,x,keep\n')
    review = shards.review_with_lines(spark, str(tmp_path))
    assert sorted((r["line"], r["email_id"], r["start"], r["text"], r["note"], r["shard"]) for r in review.collect()) == [(2, "m1", 0, "Call\nme", None, "emails-00000"), (5, "m1", 9, "abc", None, "emails-00000"), (6, "m7", None, "x", None, "emails-00000")]
    emails = spark.createDataFrame([("m1", "", "Call\nme abc", "emails-00000")], "id string, subject string, body string, shard string")
    seen = spark.createDataFrame([("m1",)], "email_id string")
    wrong = gate.judged(emails, review, review.drop("line").limit(0), seen).collect()
    assert {(r["problem"], r["line"]) for r in wrong} == {("unknown_decision", 5), ("unknown_email", 6)}
