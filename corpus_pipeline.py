"""The corpus pipeline: five stages over ``documents``, each on all that the one before it has kept.

Columns beside text and n_chars pass through every stage but the last, whatever their names. Texts are read whole, whatever
their length.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from askmine.llm import bpe, decontaminate, shingle_sets, suffix_dedup, toxicity
from askmine.llm.base import checkpointed, quoted, table
from askmine.llm.queries import RANK_FILE, TOXIC_FROM, learn_toxicity


def _with_text(row: DataFrame, columns: list[str]) -> DataFrame:
    """The columns of documents, in their order; n_chars follows the text."""
    if "n_chars" in columns:
        row = row.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(F.char_length("text").cast(row.schema["n_chars"].dataType)))
    return row.select(*[F.col(quoted(c)) for c in columns])


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is TOXIC_FROM or more go; labels are learnt from as in the operator's query.

    Null and empty texts have no toxic word and stay. Repeated rows are judged each, alike. An empty table stays empty.
    """
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"), learn=learn_toxicity())
    return toxicity.score(docs, model, carry=True).filter(F.col("score") < TOXIC_FROM).select("row.*")


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of texts at a similarity of 0.8 or more one row stays: that of the smallest doc_id (a null one counts last).

    A document is a pair of doc_id and text: rows that repeat a doc_id with another text are documents of their own, and of
    equal rows one stays. Null, empty and blank texts are copies of each other. An empty table stays empty.
    """
    return shingle_sets.one_of_each(docs)


def without_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the characters that repeated strings of 200 bytes cover; all rows stay.

    Null and empty texts stay as they are; repeated rows count as documents of their own. An empty table stays empty.
    """
    done = suffix_dedup.remove_repeats(docs, whole_characters=True, carry=True)
    return _with_text(done.select("row.*", F.col("kept").cast("string").alias("text")), docs.columns)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the spans in which benchmark windows occur; all rows stay.

    Null and empty texts stay as they are; repeated rows are treated alike. An empty table stays empty.
    """
    done = decontaminate.find(docs, table(spark, sf_dir, "benchmark"), carry=True)
    return _with_text(done.select("row.*", F.col("cleaned").alias("text")), docs.columns)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, the digests of the ids and of the bytes that they decode to, and the ids, of every row.

    Null and empty texts have no tokens. An empty table gives no rows.
    """
    path = public_tokenizers.path(RANK_FILE)
    done = bpe.round_trip(docs, path)
    return done.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"), "ids")


STAGES = [
    ("toxicity", reject_toxic),
    ("simhash_near_dedup", one_of_each_group),
    ("suffix_array_dedup", without_repeats),
    ("benchmark_decontamination", without_benchmark),
    ("byte_bpe", tokens),
]
#: SQL can't express the stages; each is tested against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs if i == 0 else checkpointed(docs), sf_dir)
    return docs
