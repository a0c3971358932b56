"""New spans for a review that is under way, as lists have grown: only what no redaction covers yet."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from askmine.functions import decisions
from askmine.functions.recognizers import Recognizer
from askmine.operators.redaction import locate

FOUND = "email_id string, field string, entity_type string, start int, end int, text string, score double, recognizer string"


def covered(start: int, end: int, intervals: list[tuple[int, int]]) -> bool:
    """Whether the union of half-open intervals has every place of [start, end)."""
    for low, high in sorted(intervals):
        if low <= start < high:
            start = high
    return start >= end


def is_covered(start: Column, end: Column, intervals: Column) -> Column:
    """covered as a column: intervals is an array of structs (a, b); a fold over them in order, without Python."""
    begin = (F.col(start) if isinstance(start, str) else start).cast("int")
    reach = F.aggregate(F.array_sort(intervals), begin, lambda at, s: F.when((s["a"] <= at) & (at < s["b"]), s["b"]).otherwise(at))
    return reach >= end


def new_spans(emails: DataFrame, review: DataFrame, known: list[Recognizer], common: dict[str, list[str]] | None = None) -> DataFrame:
    """Review rows that the review lacks, with note backfill; each redaction accepted covers for those after it.

    All places get a redact decision unless they are common terms, which the rule is asked about afterwards: a common
    term never covers another span, so its order doesn't matter.
    """
    terms = frozenset((common or {}).get("LOCATION", ()))
    spans = review.groupBy("email_id").agg(F.collect_list(F.struct("field", "start", "end", "text", "decision")).alias("spans"))
    rows = emails.select(F.coalesce("id", F.lit("")).alias("email_id"), F.coalesce("subject", F.lit("")).alias("subject"), F.coalesce("body", F.lit("")).alias("body")).join(spans, "email_id", "left")

    def run(batches):
        for batch in batches:
            out = []
            for row in batch.itertuples(index=False):
                mine = list(row.spans) if row.spans is not None else []
                for name in ("subject", "body"):
                    text = getattr(row, name)
                    own = [s for s in mine if s["field"] == name]
                    places = {(s["start"], s["end"]) for s in own}
                    redacted = [hit for s in own if s["decision"] == "redact" for hit in locate(text, s["text"], s["start"], s["end"])]
                    for r in known:
                        for a, b, score in r.hits(text):
                            if (a, b) in places or covered(a, b, redacted):
                                continue
                            places.add((a, b))
                            out.append((row.email_id, name, r.entity, a, b, text[a:b], score, r.name))
                            if " ".join(text[a:b].split()).strip(" \t\r\n.,;:!?()[]{}\"'*-–—").lower() not in terms:
                                redacted.append((a, b))
            yield pd.DataFrame(out, columns=["email_id", "field", "entity_type", "start", "end", "text", "score", "recognizer"])

    found = rows.mapInPandas(run, FOUND)
    made = decisions.decide(F.col("entity_type"), F.col("text"), F.col("score"), F.col("recognizer"), common)
    return found.withColumn("_d", made).select("*", "_d.decision", "_d.rule", F.lit("backfill").alias("note")).drop("_d")
