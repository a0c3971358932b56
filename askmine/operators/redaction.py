"""Applying reviewed spans to messages, and the checks without which nothing is written.

Where redactions overlap: one inside another goes, of equal ones the first stays, and one that reaches past an earlier
one keeps only what lies beyond it. A signature is deleted with all that it holds.
"""

from __future__ import annotations

import re
from email.utils import getaddresses

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from askmine.functions.arrow import release, slices, text_sizes
from askmine.functions.hashes import keyed_hash, plain_hash
from askmine.functions.text import n_words, without_invisible

SIGNATURE = "SIGNATURE"


def locate(text: str, wanted: str, start: int | None, end: int | None) -> list[tuple[int, int]]:
    """Where a span lies: at its offsets if they still hold its text, else wherever the text occurs."""
    if not wanted:
        return []
    if start is not None and end is not None and 0 <= start < end <= len(text) and text[start:end] == wanted:
        return [(start, end)]
    return [m.span() for m in re.finditer(re.escape(wanted), text)]


def resolved(hits: list[tuple[int, int, str]]) -> list[tuple[int, int, str]]:
    """Hits without overlap, by place."""
    kept, reach = [], -1
    for start, end, entity in sorted(hits, key=lambda h: (h[0], -h[1])):  # stable: of equal ones the first comes first
        if end > reach:  # else it lies inside one before it
            kept.append((start, end, entity))
            reach = end
    out: list[tuple[int, int, str]] = []
    for start, end, entity in kept:
        start = max(start, out[-1][1]) if out else start
        if start < end:
            out.append((start, end, entity))
    return out


def redact_text(text: str, spans: list[dict]) -> tuple[str, int, int, int]:
    """(text with tags, redactions, spans not found, characters of signatures)."""
    hits, lost = [], 0
    for s in spans:
        found = locate(text, s["text"], s["start"], s["end"])
        lost += not found
        hits += [(a, b, s["entity_type"] or "PII") for a, b in found]
    final = resolved(hits)
    parts, at = [], 0
    for a, b, entity in final:
        parts += [text[at:a], "" if entity == SIGNATURE else f"<{entity}>"]
        at = b
    out = "".join([*parts, text[at:]])
    gone = sum(b - a for a, b, e in hits if e == SIGNATURE)
    return (re.sub(r"\n{3,}", "\n\n", out).strip() if gone else out), len(final), lost, gone


_DONE = ("text", "n", "lost", "gone")


@F.arrow_udf(T.StructType([T.StructField("text", T.StringType()), *(T.StructField(c, T.IntegerType()) for c in _DONE[1:])]))
def redacted_text(texts: pa.Array, spans: pa.Array) -> pa.Array:
    kind, out = pa.struct([("text", pa.string()), *((c, pa.int32()) for c in _DONE[1:])]), []
    for a, b in slices(text_sizes(texts)):
        pairs = zip(texts.slice(a, b - a).to_pylist(), spans.slice(a, b - a).to_pylist())
        out.append(pa.array([dict(zip(_DONE, redact_text(t or "", own or []))) for t, own in pairs], kind))
    done = pa.concat_arrays(out) if out else pa.array([], kind)
    release()
    return done


@F.pandas_udf(T.ArrayType(T.StringType()))
def addresses(headers: pd.Series) -> pd.Series:
    return headers.map(lambda h: [a for _, a in getaddresses([h or ""]) if a])


def redact(emails: DataFrame, review: DataFrame, key: bytes | None = None) -> DataFrame:
    """emails with redacted subject and body, n_redacted, n_lost and signature_chars; with a key, ids and addresses hashed."""
    wanted = review.filter("decision = 'redact'").groupBy("email_id").agg(
        *[F.collect_list(F.when(F.col("field") == f, F.struct("start", "end", "text", "entity_type"))).alias(f"_{f}") for f in ("subject", "body")]
    )  # the spans of one message
    rows = emails.withColumn("_id", F.coalesce("id", F.lit(""))).join(wanted, F.col("_id") == F.col("email_id"), "left")
    for f in ("subject", "body"):
        rows = rows.withColumn(f"_{f}", redacted_text(without_invisible(F.coalesce(F.col(f), F.lit(""))), F.col(f"_{f}"))).withColumn(f, F.col(f"_{f}.text"))
    total = lambda c: F.col(f"_subject.{c}") + F.col(f"_body.{c}")
    out = rows.withColumns({"n_redacted": total("n"), "n_lost": total("lost"), "signature_chars": total("gone"), "n_words": n_words(F.col("body"))})
    out = out.drop("_id", "email_id", "_subject", "_body")
    if key is not None:
        out = out.withColumn("id", plain_hash(F.col("id"))).drop("from")
        if "sender" in out.columns:
            out = out.withColumn("sender", keyed_hash(F.col("sender"), key))
        if "to" in out.columns:
            out = out.withColumn("to", F.transform(addresses("to"), lambda a: keyed_hash(a, key)))
        if "attachments" in out.columns:
            out = out.withColumn("attachments", F.transform("attachments", lambda a: a.withField("filename", keyed_hash(a["filename"], key))))
    return out


def problems(emails: DataFrame, review: DataFrame, original: DataFrame, analyzed: DataFrame) -> DataFrame:
    """problem, email_id (and line, of a review that has it): unknown decisions, deleted rows (as a multiset), spans of unknown or unanalyzed messages."""
    lines = "line" in review.columns

    def named(df: DataFrame, problem: str, c: str) -> DataFrame:
        line = [(F.col("line") if "line" in df.columns else F.lit(None)).cast("bigint").alias("line")] if lines else []
        return df.select(F.lit(problem).alias("problem"), F.col(c).alias("email_id"), *line)

    ids = emails.select(F.coalesce("id", F.lit("")).alias("email_id")).distinct()
    place = ["email_id", "field", "start", "end"]
    undecided = review.filter(~F.coalesce(F.lower(F.trim("decision")), F.lit("")).isin("redact", "keep"))
    return (
        named(undecided, "unknown_decision", "email_id")
        .unionByName(named(original.select(*place).exceptAll(review.select(*place)), "deleted_row", "email_id"))
        .unionByName(named(review.join(ids, "email_id", "left_anti"), "unknown_email", "email_id"))
        .unionByName(named(ids.join(analyzed.select("email_id").distinct(), "email_id", "left_anti"), "not_analyzed", "email_id"))
    )
