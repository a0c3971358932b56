"""Cutting long bodies into even chunks of whole paragraphs or sentences."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from askmine.functions.arrow import by_slices
from askmine.functions.text import has_content, n_words

TARGET_WORDS = 300
PARAGRAPH, SENTENCE = re.compile(r"\n\s*\n"), re.compile(r"(?<=[.!?])\s+")


def _even(total: int, most: int) -> int:
    """The size of equal parts of at most ``most``."""
    return -(-total // -(-total // most))


def pieces(body: str, most: int = TARGET_WORDS) -> Iterator[tuple[str, int, bool]]:
    """(text, words, whether a paragraph starts): paragraphs, or sentences of long ones, or even windows of long sentences."""
    for paragraph in PARAGRAPH.split(body):
        count = len(paragraph.split())
        if count <= most:
            if count:
                yield paragraph.strip(), count, True
            continue
        starts = True
        for sentence in map(str.split, SENTENCE.split(paragraph)):
            step = _even(len(sentence), most) if sentence else 1
            for window in (sentence[i : i + step] for i in range(0, len(sentence), step)):
                yield " ".join(window), len(window), starts
                starts = False


def chunks(body: str | None, most: int = TARGET_WORDS) -> list[str]:
    """Chunks of at most ``most`` words, of even size; no word is lost. A short body is one chunk, a blank one none."""
    body = body or ""
    total = len(body.split())
    if total <= most:
        return [body.strip()] if total else []
    enough = _even(total, most)
    out: list[list[str]] = []
    size = most + 1  # so that the first piece opens a chunk
    for text, count, starts in pieces(body, most):
        if size + count > most or size >= enough:
            out.append([text])
            size = 0
        else:
            out[-1] += ["\n\n" if starts else " ", text]
        size += count
    return ["".join(parts) for parts in out]


#: The chunks of a text. Not deterministic to Spark, so that a filter on them doesn't have every text cut a second time.
chunks_of = by_slices(chunks, T.ArrayType(T.StringType()), pa.list_(pa.string())).asNondeterministic()


def chunked(messages: DataFrame, body: str, keep_empty: bool = False) -> DataFrame:
    """A row per chunk with content: chunk_index, n_chunks, n_words, text. Numbers count the chunks that stay."""
    parts = chunks_of(F.col(body))
    kept = messages.withColumn("_parts", parts)
    if not keep_empty:
        kept = kept.withColumn("_parts", F.filter("_parts", has_content))
    return kept.select("*", F.posexplode("_parts").alias("chunk_index", "text_of_chunk"), F.size("_parts").alias("n_chunks")).withColumn("n_words", n_words(F.col("text_of_chunk"))).drop("_parts", body).withColumnRenamed("text_of_chunk", "text")
