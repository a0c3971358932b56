"""Signature zones by columns and windows, on literal messages: what goes, what stays, and rows of every odd kind."""

from pyspark.sql import functions as F

from askmine.operators.zones import with_zone

KIND = {
    "Kelly Tran": "PERSON", "Ann": "PERSON", "714-555-0100": "PHONE_NUMBER", "kelly@example.com": "EMAIL_ADDRESS", "www.example.com": "URL",
    "Acme": "ORGANIZATION", "Irvine": "LOCATION",
}
#: (text, what of it is the signature)
CASES = [
    ("Do you have lions for Saturday?\n\nBest,\nKelly Tran\nDirector\n714-555-0100\nkelly@example.com", "Best,\nKelly Tran\nDirector\n714-555-0100\nkelly@example.com"),
    # closings one over the other, with blank lines
    ("Can we book?\n\nThank you so much\n\nBest regards\nKelly Tran\n714-555-0100", "Thank you so much\n\nBest regards\nKelly Tran\n714-555-0100"),
    # an opening bracket goes with its span
    ("See below\nfor the event.\n<Kelly Tran> <kelly@example.com>", "<Kelly Tran> <kelly@example.com>"),
    # a legal notice below is part of it
    ("Is it free?\nKelly Tran\nwww.example.com\nThis mail is confidential and only for the one who was named above", "Kelly Tran\nwww.example.com\nThis mail is confidential and only for the one who was named above"),
    # what a person says stays: above, in the block, and below it
    ("My name is Kelly Tran, call me at 714-555-0100.\nCan you come?", None),
    ("Kelly Tran\n714-555-0100\nP.S. bring the drums", None),
    ("Date of the event: Kelly Tran\nVenue: Irvine 714-555-0100", None),
    ("Day of Contact: Kelly Tran 714-555-0100", None),
    # a sentence broken over lines goes on in lower case, within the block (a line of up to four words would be taken for a title)
    ("Kelly Tran\nWe met you at the fair with\nfriends from the big town of Irvine\n714-555-0100", "714-555-0100"),
    ("Hello Kelly Tran\n714-555-0100", None),
    # far apart, or of one kind: no block
    ("Kelly Tran " + "x" * 300 + " 714-555-0100", None),
    ("714-555-0100 and 714-555-0100", None),
    # no contacts: a closing or a name near the end, up to where talk starts anew
    ("Can we book two lions?\n\nThank you,\nKelly Tran\nEvent Director\nP.S. we have drums too", "Thank you,\nKelly Tran\nEvent Director\n"),
    ("We saw the lions.\nThanks, Ann\nAcme Events", "Thanks, Ann\nAcme Events"),
    ("Kelly Tran", None),
    ("The lions danced\nKelly Tran", None),
    ("", None),
]


def spans_of(text):
    return [(i, i + len(k), e) for k, e in KIND.items() for i in range(len(text)) if text.startswith(k, i)]


def test_literal_messages(spark):
    rows = [(n, text, spans_of(text)) for n, (text, _) in enumerate(CASES)]
    df = spark.createDataFrame(rows, "n int, text string, marked array<struct<start:int,end:int,entity_type:string>>")
    got = {r["n"]: r["zone"] and r["text"][r["zone"]["start"] : r["zone"]["end"]] for r in with_zone(df, "text", F.col("marked")).collect()}
    assert got == {n: kept for n, (_, kept) in enumerate(CASES)}


def test_odd_rows(spark):
    text = "Free on Saturday?\nBest,\nKelly Tran\n714-555-0100"
    long = "word " * 40_000 + "\n" + "line\n" * 2_000 + text
    rows = [(1, None, spans_of(text)[:0], 9), (2, text, None, 9), (3, text, spans_of(text), 9), (3, text, spans_of(text), 9), (4, long, spans_of(text), 9), (5, long, [(a + len(long) - len(text), b + len(long) - len(text), e) for a, b, e in spans_of(text)], 9)]
    df = spark.createDataFrame(rows, "n int, text string, marked array<struct<start:int,end:int,entity_type:string>>, `event` int").withColumnRenamed("event", "key")
    found = with_zone(df, "text", F.col("marked"))
    got = sorted((r["n"], tuple(r["zone"]) if r["zone"] else None) for r in found.collect())
    start = text.index("Best")
    assert [g for g in got if g[0] != 4] == [(1, None), (2, None), (3, (start, len(text))), (3, (start, len(text))), (5, (start + len(long) - len(text), len(long)))]
    assert found.columns == ["n", "text", "marked", "key", "zone"] and with_zone(df.limit(0), "text", F.col("marked")).count() == 0
    assert "Python" not in found._jdf.queryExecution().executedPlan().toString()
