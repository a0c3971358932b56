"""Held-out threads: their test queries, without those that another thread asks too, and the check that nothing leaks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from askmine.functions.hashes import is_held_out, split_rank
from askmine.operators import threads
from askmine.sources.files import read_texts


class Leak(Exception):
    """Something held out is named where it must not be."""


def queries(emails: DataFrame) -> DataFrame:
    """Every held-out thread: thrid, rank, id, kind, lang, text, reason ("" for a test query), in the order of the hash."""
    own = emails.filter("direction = 'outbound'").select("sender")
    picked = threads.first_client_message(emails, own).filter(is_held_out(F.col("thrid")))
    return threads.with_near_duplicates_named(picked, emails).withColumn("rank", split_rank(F.col("thrid"))).orderBy("rank")


def check(spark: SparkSession, folder: str, ids: DataFrame, id_column: str = "id") -> None:
    """Raise Leak if any text below a folder names a held-out id."""
    found = threads.leaks(read_texts(spark, folder), "text", ids, id_column)
    hits = found.groupBy("path").agg(F.count(F.lit(1)).alias("n")).orderBy("path").limit(20).collect()
    if hits:
        raise Leak("; ".join(f"{r['path']}: {r['n']}" for r in hits))
