"""Seeding the word lists, and sampling messages for review."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterable
from email.utils import getaddresses

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from askmine.functions.text import is_place_term, normalized_term, venue_part
from askmine.operators.dedupe import contained

#: The recognizer whose spans vote, least mentions, and least share of tagged ones.
VOTER, LEAST_MENTIONS, LEAST_SHARE = "SpacyRecognizer", 2, 0.5
_PART, _SPLIT = re.compile(r"[^\W\d_][^\W\d_'’-]*[^\W\d_]"), re.compile(r"[\s,;\"()<>]+")


def fold(text: str) -> str:
    """Without accents; the barred d becomes a plain one."""
    return "".join(c for c in unicodedata.normalize("NFKD", text.translate({0x111: "d", 0x110: "D"})) if not unicodedata.combining(c))


def name_parts(display: str) -> list[str]:
    return [p.title() for p in _SPLIT.split(unicodedata.normalize("NFC", display)) if _PART.fullmatch(p)]


def names_in(headers: Iterable[str | None], surnames: frozenset[str]) -> list[str]:
    """Parts of the display names that hold a known surname, as written and without accents, once each."""
    found: set[str] = set()
    for display, _ in getaddresses([h or "" for h in headers]):
        parts = name_parts(display)
        if surnames & {fold(p) for p in parts}:
            found.update(parts, map(fold, parts))
    return sorted(found)


def name_harvest(emails: DataFrame, surnames: list[str]) -> DataFrame:
    """part, n: messages whose From or To names hold it together with a known surname; seed surnames with 0 too."""
    known = frozenset(surnames)

    @F.pandas_udf("array<string>")
    def parts(senders: pd.Series, receivers: pd.Series) -> pd.Series:
        return pd.Series([names_in(pair, known) for pair in zip(senders, receivers)], dtype=object)

    seeds = emails.sparkSession.createDataFrame([(s,) for s in sorted(known)], "part string").withColumn("n", F.lit(0))
    counted = emails.select(F.explode(parts("from", "to")).alias("part"), F.lit(1).alias("n"))
    return counted.unionByName(seeds).groupBy("part").agg(F.sum("n").alias("n"))


def split_ambiguous(counted: DataFrame, entry: str, english: DataFrame) -> DataFrame:
    """counted with ambiguous: whether the entry, in lower case, is an everyday word (column word of english)."""
    words = english.select(F.col("word").alias("_w")).distinct().withColumn("_known", F.lit(True))
    return counted.join(words, F.lower(entry) == F.col("_w"), "left").withColumn("ambiguous", F.coalesce("_known", F.lit(False))).drop("_w", "_known")


def place_votes(emails: DataFrame, review: DataFrame) -> DataFrame:
    """term, mentions, tagged: every appearance of the terms that the voter tagged, and those inside its spans."""
    spans = review.filter((F.col("entity_type") == "LOCATION") & (F.col("recognizer") == VOTER))
    listed = spans.select(normalized_term(F.col("text")).alias("term")).distinct().filter(is_place_term(F.col("term")))

    @F.pandas_udf("array<struct<start:int,end:int,text:string>>")
    def mentions(texts: pd.Series, terms: pd.Series) -> pd.Series:
        def of(text: str, own: list[str]) -> list[dict]:
            shape = "|".join(r"\s+".join(map(re.escape, term.split(" "))) for term in sorted(own, key=lambda x: (-len(x), x)))
            return [{"start": m.start(), "end": m.end(), "text": m.group()} for m in re.finditer(rf"(?<![\w@./])(?:{shape})(?![\w@])", text, re.IGNORECASE)]

        return pd.Series([of(t, list(own)) for t, own in zip(texts, terms)], dtype=object)

    fields = F.explode(F.array(*[F.struct(F.lit(f).alias("field"), F.coalesce(F.col(f), F.lit("")).alias("value")) for f in ("subject", "body")]))
    texts = emails.select(F.coalesce("id", F.lit("")).alias("email_id"), fields.alias("f")).select("email_id", "f.field", "f.value")
    # a text is searched for the terms only whose first word it has: an equi join finds them, however many terms there are
    words = texts.select("email_id", "field", F.explode(F.array_distinct(F.regexp_extract_all(F.lower("value"), F.lit("([a-z]+)"), 1))).alias("_w"))
    maybe = words.join(listed.withColumn("_w", F.regexp_extract("term", "^[a-z]+", 0)), "_w").groupBy("email_id", "field").agg(F.collect_set("term").alias("_terms"))
    found = texts.join(maybe, ["email_id", "field"]).select("email_id", "field", F.explode(mentions("value", "_terms")).alias("m"))
    each = found.select("email_id", "field", "m.*").distinct()
    low = spans.select("email_id", "field", F.col("start").cast("int").alias("low"), F.col("end").cast("int").alias("high"))
    votes = each.groupBy(normalized_term(F.col("text")).alias("term")).agg(F.count(F.lit(1)).alias("mentions"))
    inside = contained(each, low, ["email_id", "field"], "start", "end", "low", "high")
    tagged = inside.groupBy(normalized_term(F.col("text")).alias("term")).agg(F.count(F.lit(1)).alias("tagged"))
    return votes.join(tagged, "term", "left").fillna(0, ["tagged"])


def selected_places(votes: DataFrame, common: list[str]) -> DataFrame:
    return votes.filter((F.col("mentions") >= LEAST_MENTIONS) & (F.col("tagged") >= LEAST_SHARE * F.col("mentions")) & ~F.col("term").isin(*(common or [""])))


def split_places(selected: DataFrame, english: DataFrame) -> DataFrame:
    """section (places or capitalized), entry: a place of one word that is an everyday word too counts only with a capital."""
    everyday = english.select(F.col("word").alias("term"), F.lit(True).alias("_known")).distinct()
    known = selected.join(everyday, "term", "left").withColumn("_known", F.coalesce("_known", F.lit(False)) & ~F.col("term").contains(" "))
    capital = F.concat(F.upper(F.substring("term", 1, 1)), F.substring("term", 2, 1 << 20))
    return known.select(F.when(F.col("_known"), "capitalized").otherwise("places").alias("section"), F.when(F.col("_known"), capital).otherwise(F.col("term")).alias("entry"), "mentions", "tagged")


def split_names(counted: DataFrame, english: DataFrame) -> DataFrame:
    """section (names or ambiguous), entry, n, of name_harvest."""
    return split_ambiguous(counted, "part", english).select(F.when(F.col("ambiguous"), "ambiguous").otherwise("names").alias("section"), F.col("part").alias("entry"), "n")


def venue_harvest(values: DataFrame, value: str, listed: list[str]) -> DataFrame:
    """term, spelling (the most common one, the smaller of equals), n of label values that no list has."""
    parts = values.select(venue_part(F.col(value)).alias("spelling")).withColumn("term", normalized_term(F.col("spelling")))
    new = parts.filter((F.col("term") != "") & ~F.col("spelling").rlike(r"^\d") & F.col("spelling").rlike(r"\p{Lu}") & ~F.col("term").isin(*(listed or [""])))
    counted = new.groupBy("term", "spelling").agg(F.count(F.lit(1)).alias("k"))
    return counted.groupBy("term").agg(F.min(F.struct(-F.col("k"), F.col("spelling")))["spelling"].alias("spelling"), F.sum("k").alias("n"))


def leaking(terms: DataFrame, term: str, texts: DataFrame, key: str, text: str) -> DataFrame:
    """term, n: texts that hold it outside tags, whole, by letters, digits and underscores.

    An equi join on the term's first word and a plain search come before the pattern, which is then tried on few texts.
    """
    clean = texts.select(F.col(key).alias("_k"), F.lower(F.regexp_replace(text, r"<[A-Z_]+>", " ")).alias("_t"))
    words = clean.select("_k", "_t", F.explode(F.array_distinct(F.regexp_extract_all("_t", F.lit(r"[\p{L}\p{N}_]+"), 0))).alias("_w"))
    first = terms.select(F.col(term).alias("term")).withColumn("_w", F.regexp_extract("term", r"[\p{L}\p{N}_]+", 0))
    whole = F.expr(r"_t rlike concat('(?<![\\p{L}\\p{N}_])\\Q', term, '\\E(?![\\p{L}\\p{N}_])')")
    held = words.join(first, "_w").filter(F.when(F.contains("_t", "term"), whole).otherwise(F.lit(False)))
    return held.groupBy("term").agg(F.count_distinct("_k").alias("n"))


def stratified(rows: DataFrame, key: str, stratum: str, n: int, seed: int = 0) -> DataFrame:
    """n rows of each stratum by the order of a hash of the key: the same at every run."""
    draw = F.sha2(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string")), 256)
    order = W.partitionBy(stratum).orderBy("_draw", key)
    return rows.withColumn("_draw", draw).withColumn("_rn", F.row_number().over(order)).filter(F.col("_rn") <= n).drop("_draw", "_rn")


def top_person_terms(review: DataFrame, top: int = 20) -> DataFrame:
    """term, n: the most frequent redacted names, equal ones in alphabetical order."""
    people = review.filter((F.col("entity_type") == "PERSON") & (F.col("decision") == "redact")).select(normalized_term(F.col("text")).alias("term")).filter("term <> ''")
    return people.groupBy("term").agg(F.count(F.lit(1)).alias("n")).orderBy(F.col("n").desc(), "term").limit(top)


def review_sample(emails: DataFrame, review: DataFrame, size: int, top: int = 20, seed: int = 0) -> DataFrame:
    """size messages with the reason of their choice: one for each of the most frequent redacted names, then at random.

    A name takes the first message by hash that no name before it has taken; names are few, so the loop is on the driver.
    """
    people = review.filter((F.col("entity_type") == "PERSON") & (F.col("decision") == "redact")).select("email_id", normalized_term(F.col("text")).alias("term")).filter("term <> ''")
    known = people.join(emails.select(F.coalesce("id", F.lit("")).alias("email_id")).distinct(), "email_id", "left_semi")
    names = [r["term"] for r in top_person_terms(review, top).collect()]
    draw = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("email_id")), 256)
    chosen: dict[str, str] = {}
    for rank, name in enumerate(names, 1):
        if len(chosen) < size and (row := known.filter((F.col("term") == name) & ~F.col("email_id").isin(*(list(chosen) or [""]))).orderBy(draw, "email_id").first()):
            chosen[row["email_id"]] = f"top PERSON #{rank}: {name}"
    ids = emails.select(F.coalesce("id", F.lit("")).alias("email_id")).distinct().filter(~F.col("email_id").isin(*(list(chosen) or [""])))
    picked = emails.sparkSession.createDataFrame([(k, v) for k, v in chosen.items()], "email_id string, reason string")
    rest = ids.orderBy(draw, "email_id").limit(max(0, size - len(chosen))).withColumn("reason", F.lit("random"))
    return picked.unionByName(rest)
