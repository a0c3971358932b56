"""The span table: what the recognizers find in each message, decided on, with its signature zone."""

from __future__ import annotations

from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from askmine.functions import decisions
from askmine.functions.arrow import by_slices
from askmine.functions.recognizers import Recognizer, recognizers, scan
from askmine.functions.text import without_invisible
from askmine.operators.zones import with_zone

ZONE = T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())])
FOUND = T.ArrayType(T.StructType([*ZONE.fields, T.StructField("entity_type", T.StringType()), T.StructField("score", T.DoubleType()), *(T.StructField(c, T.StringType()) for c in ("recognizer", "text", "context"))]))
ARROW_FOUND = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("entity_type", pa.string()), ("score", pa.float64()), *((c, pa.string()) for c in ("recognizer", "text", "context"))]))
#: Characters of context on each side of a span.
AROUND = 40


def context_of(text: str, start: int, end: int) -> str:
    return " ".join(f"{text[max(0, start - AROUND) : start]}[[{text[start:end]}]]{text[end : end + AROUND]}".split())


def scanner(known: list[Recognizer] | None = None, allowed: frozenset[str] = frozenset(), reader: Callable | None = None, parser: Callable | None = None) -> Callable[[Column], Column]:
    """An Arrow UDF of a text to its spans. reader: names and places of a text; parser: its tokens, which score ambiguous words (see recognizers.scan)."""
    own = recognizers() if known is None else known

    def found(t: str | None) -> list[dict]:
        return [{"start": a, "end": b, "entity_type": e, "score": s, "recognizer": r, "text": t[a:b], "context": context_of(t, a, b)} for a, b, e, s, r in scan(t or "", own, allowed, reader, parser)]

    return by_slices(found, FOUND, ARROW_FOUND)


def scanned(text: Column) -> Column:
    return scanner()(text)


def flagged(emails: DataFrame, known: list[Recognizer] | None = None, common: dict[str, list[str]] | None = None, allowed: frozenset[str] = frozenset(), reader: Callable | None = None, parser: Callable | None = None) -> DataFrame:
    """A review row per span of subject and body, and one per signature.

    The texts are scanned once; decisions are CASE expressions inside the arrays. Lines and spans are shuffled once, for the zones.
    """
    find = scanner(known, allowed, reader, parser)
    decide = lambda s: decisions.decide(s["entity_type"], s["text"], s["score"], s["recognizer"], common)
    rows = emails
    fields = [f for f in ("subject", "body") if f in emails.columns]
    for f in fields:
        rows = rows.withColumn(f, without_invisible(F.coalesce(F.col(f), F.lit("")))).withColumn(f"_{f}", find(F.col(f)))
    for f in fields:
        rows = rows.withColumn(f"_{f}", F.transform(f"_{f}", lambda s: F.struct(*[s[c].alias(c) for c in ("start", "end", "entity_type", "text", "context", "score", "recognizer")], decide(s)["decision"].alias("decision"), decide(s)["rule"].alias("rule"))))
    rows = with_zone(rows, "body", F.filter("_body", lambda s: s["decision"] == "redact"), "_zone")
    z = F.col("_zone")
    signature = F.when(z["start"].isNotNull(), F.array(F.struct(z["start"].alias("start"), z["end"].alias("end"), F.lit("SIGNATURE").alias("entity_type"), F.expr("substring(body, _zone.start + 1, _zone.end - _zone.start)").alias("text"), F.lit("").alias("context"), F.lit(1.0).alias("score"), F.lit("signature").alias("recognizer"), F.lit("redact").alias("decision"), F.lit("signature_block").alias("rule"))))
    named = lambda f: lambda s: F.struct(F.lit(f).alias("field"), s.alias("s"))
    by_field = [F.transform(f"_{f}", named(f)) for f in fields]
    by_field.append(F.coalesce(F.transform(signature, lambda s: F.struct(F.lit("body").alias("field"), s.alias("s"))), F.array().cast("array<struct<field:string,s:struct<start:int,end:int,entity_type:string,text:string,context:string,score:double,recognizer:string,decision:string,rule:string>>>")))
    thread = F.col("thrid") if "thrid" in emails.columns else F.lit(None).cast("string")
    out = rows.select(F.coalesce(F.col("id"), F.lit("")).alias("email_id"), thread.alias("thrid"), F.explode(F.concat(*by_field)).alias("x"))
    return out.select("email_id", "thrid", "x.field", "x.s.*", F.lit("").alias("note"))


def zones(messages: DataFrame, text: str, spans: Column) -> DataFrame:
    """messages with zone_start and zone_end, null where there is no signature; spans: the redactions of the text."""
    found = with_zone(messages, text, spans, "_zone")
    return found.select(*messages.columns, F.col("_zone.start").alias("zone_start"), F.col("_zone.end").alias("zone_end"))
