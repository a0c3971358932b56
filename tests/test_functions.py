import hashlib
import hmac

import pytest
from pyspark.sql import functions as F

from askmine.functions import cleaning, decisions, hashes, recognizers, tripwire
from askmine.functions import text as t
from askmine.operators.chunking import chunks


def one(spark, value, column):
    return spark.createDataFrame([(value,)], "x string").select(column(F.col("x")).alias("y")).first()["y"]


def test_split_is_pinned(spark):
    rows = spark.range(100).select(F.concat(F.lit("t"), F.col("id").cast("string")).alias("k"))
    held = {r["k"] for r in rows.filter(hashes.is_held_out(F.col("k"))).collect()}
    assert held == {"t20", "t28", "t37", "t42", "t53", "t66", "t77", "t83", "t91"}
    expected = int.from_bytes(hashlib.sha256(b"42:").digest()[:8], "big") / 2**64
    assert one(spark, None, hashes.split_rank) == expected < 0.1


def test_keyed_hash_is_hmac(spark):
    key = b"k" * 80
    expected = hmac.new(key, "ann@example.com".encode(), hashlib.sha256).hexdigest()[:16]
    assert one(spark, " Ann@Example.com ", lambda c: hashes.keyed_hash(c, key)) == expected
    assert one(spark, None, lambda c: hashes.keyed_hash(c, key)) == ""
    assert one(spark, " a ", hashes.plain_hash) == hashlib.sha256(b"a").hexdigest()[:16]


@pytest.mark.parametrize(
    ("column", "value", "expected"),
    [
        (t.dedupe_key, "  Hello \n World ", "hello world"),
        (t.normalized_term, " Good  Morning! ", "good morning"),
        (t.without_invisible, "a​b﻿c­", "abc"),
        (t.has_content, "Thanks <PERSON>!", False),
        (t.has_content, "can you come", True),
        (t.is_vietnamese, "được ơn ư ă ề", True),
        (t.is_vietnamese, "déjà vu à la carte", False),
        (t.without_flat_quote, "thanks! On <DATE_TIME> at 07:23:59 PM, <PERSON> wrote: Hello", "thanks!"),
        (t.is_reply, "Fwd: Re: lions", True),
        (t.is_reply, "Fwd: lions", False),
        (t.sender_address, "Ann <Ann.Lee@Example.com>", "ann.lee@example.com"),
        (t.venue_part, "Sunny Pavilion, Irvine CA", "Sunny Pavilion"),
        (t.is_place_term, "mt. sac", True),
        (t.is_place_term, "abc", False),
        (t.n_words, " a b  c ", 3),
    ],
)
def test_text(spark, column, value, expected):
    assert one(spark, value, column) == expected


def test_shingles(spark):
    assert one(spark, "A b c <PERSON> d e f", t.shingles) == ["a b c d e", "b c d e f"]
    assert one(spark, "too short", t.shingles) == []


@pytest.mark.parametrize(
    ("value", "entity"),
    [("call 714-555\n0100", "PHONE_NUMBER"), ("a@b.co", "EMAIL_ADDRESS"), ("www.x.org", "URL"), ("see @lion_dance", "SOCIAL_HANDLE"), ("image001.png@01D5A2B3.C4D5E6F0", None), ("at @5pm", None), ("7145550100", None)],
)
def test_tripwire_in_both_engines(spark, value, entity):
    assert {e for e, _, _ in tripwire.hits(value)} == ({entity} if entity else set())
    fired = [e for e in tripwire.SHAPES if one(spark, value, lambda c, e=e: tripwire.fires(c, e))]
    assert fired == ([entity] if entity else [])


@pytest.mark.parametrize(
    ("values", "expected"),
    [((0.6, 0.9, 0.9, 0.9, 9), "skip/non_english"), ((0.6, 0, 0.5, 0.9, 9), "skip/template"), ((0.6, 0, 0, 0.3, 9), "skip/footer"), ((0.6, 0, 0, 0, 3), "review/markup"), ((0.1, 0, 0, 0, 0), "review/few_questions"), ((0.11, 0, 0, 0, 2), "faq/")],
)
def test_triage(spark, values, expected):
    made = decisions.triage(*map(F.lit, values))
    assert "/".join(spark.range(1).select(made.alias("t")).first()["t"]) == expected


def test_decisions_with_clock_before_duration(spark):
    rows = spark.createDataFrame([("DATE_TIME", "10am for 15 minutes", 0.5, "x"), ("DATE_TIME", "October 22, 15 minutes early", 0.5, "x")], "e string, t string, s double, r string")
    made = rows.select(decisions.decide(F.col("e"), F.col("t"), F.col("s"), F.col("r")).alias("d")).collect()
    assert [r["d"]["rule"] for r in made] == ["clock_time", "calendar_date"]


@pytest.mark.parametrize(
    ("html", "expected"),
    [("<p>a &amp; b</p><style>x</style>c", "\na & b\nc"), ("<head><title>t</title></head><body>x<br>y</body>", "x\ny"), ("plain", "plain"), (None, "")],
)
def test_html(html, expected):
    assert cleaning.html_to_text(html) == expected


@pytest.mark.parametrize(
    ("text", "expected"),
    [
        ("Hi\n\nOn Mon, Jan 1, Ann wrote:\n> old", "Hi"),
        ("Hi\n> quoted\nthere", "Hi\nthere"),
        ("Hello\n-- \nAnn", "Hello"),
        ("Hello\nSent from my iPhone", "Hello"),
        ("Hello\n\n\n\n\nthere   you", "Hello\n\nthere you"),
        ("Deal\n© 2024 Shop", "Deal"),
        ("On Sunday we wrote a song", "On Sunday we wrote a song"),
        (None, ""),
    ],
)
def test_strip_quoted(text, expected):
    assert cleaning.strip_quoted(text) == expected


def test_unwrap_lead():
    wrapped = "Ann sent you a new message:\nNew Message\nDo you have lions?\nFor: the wedding"
    assert cleaning.unwrap_lead(wrapped, "leads@weddingwire.com") == "Do you have lions?"
    assert cleaning.unwrap_lead(wrapped, "ann@example.com") == wrapped
    assert cleaning.unwrap_lead("sent you a new message:\nFor: x", "a@weddingpro.com") == "sent you a new message:\nFor: x"


def found(text, **lists):
    return [(text[a:b], r) for a, b, _, _, r in recognizers.scan(text, recognizers.recognizers(**lists))]


@pytest.mark.parametrize(
    ("text", "expected"),
    [
        ("at 1234 Oak St Apt 5 today", ("1234 Oak St Apt 5", "street_address")),
        ("Policy No: AB-12345", ("AB-12345", "insurance_policy")),
        ("order #123456", ("123456", "order_id")),
        ("on 8.23.27", ("8.23.27", "dotted_date")),
        ("Costa Mesa 92626", ("92626", "us_zip")),
        ("Hi Fremont Elementary", ("Fremont Elementary", "venue_name")),
        ("Location: the old barn", ("the old barn", "label_location")),
        ("Lee714-555-0100", ("Lee714-555-0100", "loose_phone")),
        ("see https://x.org/a.", ("https://x.org/a", "loose_url")),
        ("ann@example.com", ("ann@example.com", "loose_email")),
        ("card 4111 1111 1111 1111", ("4111 1111 1111 1111", "credit_card")),
    ],
)
def test_recognizers(text, expected):
    assert expected in found(text)


@pytest.mark.parametrize("text", ["costs $95,000", "order 2024", "Elementary School", "call me at 10am", "in 92618 ways, 1,92618"])
def test_recognizers_ignore(text):
    assert not [x for x in found(text) if x[1] in ("order_id", "venue_name", "street_address") or (x[1] == "us_zip" and "$" in text)]


def test_lists_and_context():
    assert ("huynh", "denylist_names") in found("pls send to huynh", names=["Huynh"])
    assert found("the do is here", ambiguous=["Do"]) == []
    both = found("White Palace Ballroom", venues=["White Palace", "Palace Ballroom"])
    assert ("White Palace", "denylist_venues") in both and ("Palace Ballroom", "denylist_venues") in both
    ein = recognizers.scan("our tax id is 12-3456789", recognizers.recognizers())
    assert ein[0][3] == pytest.approx(0.75)
    assert recognizers.ambiguous_score(None, 0) is None
    assert recognizers.ambiguous_score([(0, 2, "PROPN", ""), (3, 9, "PROPN", "")], 0) == 0.85
    assert recognizers.ambiguous_score([(0, 2, "DET", "")], 0) == 0.2


@pytest.mark.parametrize(("words", "sizes"), [(0, []), (300, [300]), (310, [155, 155]), (650, [217, 217, 216])])
def test_chunks_are_even(words, sizes):
    body = " ".join(f"w{i}" for i in range(words))
    made = chunks(body)
    assert [len(c.split()) for c in made] == sizes
    assert " ".join(made).split() == body.split()


def test_chunks_keep_paragraphs():
    body = "\n\n".join(" ".join(f"p{i}w{j}" for j in range(110)) for i in range(5))
    made = chunks(body)
    assert all("\n\n" in c for c in made[:1]) and " ".join(made).split() == body.split()
    assert chunks(None) == [] and chunks(" \n ") == []
