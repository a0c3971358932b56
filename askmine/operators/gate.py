"""The redaction gate as one run: reviewed shards whose every check holds are written, the others are refused, with reasons."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from askmine.operators import redaction, reports
from askmine.operators.dedupe import cut
from askmine.sources import files, shards


def analyzed(spark: SparkSession, folder: str) -> DataFrame:
    """email_id: the messages that the views of a folder show, by the files that name them (see reports.views); none without such files."""
    try:
        rows = spark.read.schema("email_id string").json(f"{folder}/{reports.ANALYZED}-*.jsonl")
    except AnalysisException:
        rows = spark.createDataFrame([], "email_id string")
    return rows.distinct()


def judged(emails: DataFrame, review: DataFrame, original: DataFrame, seen: DataFrame) -> DataFrame:
    """problem, email_id, shard (and line, of a review that has it) of every check that fails, span texts that are nowhere among them.

    emails, review and original have a shard; a review's row must be of a message of its own shard.
    """
    of = emails.select(F.coalesce("id", F.lit("")).alias("email_id"), "shard").distinct()
    found = redaction.problems(emails, review, original, seen).join(of.unionByName(review.select("email_id", "shard")).distinct(), "email_id", "left")
    lost = redaction.redact(emails, review).filter("n_lost > 0").select(F.lit("text_not_found").alias("problem"), F.coalesce("id", F.lit("")).alias("email_id"), "shard")
    apart = review.join(of.withColumnRenamed("shard", "_own"), "email_id").filter("shard <> _own").select(F.lit("other_shard").alias("problem"), "email_id", "shard", *(["line"] if "line" in review.columns else []))
    return found.unionByName(lost, allowMissingColumns=True).unionByName(apart, allowMissingColumns=True)


def passed(emails: DataFrame, review: DataFrame, original: DataFrame, seen: DataFrame, key: bytes | None = None) -> tuple[DataFrame, DataFrame]:
    """(redacted messages of the shards without problems, problems). Shards that nobody reviewed are left for later."""
    reviewed = emails.join(review.select("shard").distinct(), "shard", "left_semi").select(*emails.columns)
    wrong = cut(judged(reviewed, review, original, seen).distinct())
    clean = reviewed.join(wrong.select("shard").distinct(), "shard", "left_anti").select(*emails.columns)
    return redaction.redact(clean, review.drop("shard", "line"), key), wrong


def run(spark: SparkSession, emails: str, reviews: str, originals: str, views: str, out: str, key_file: str) -> DataFrame:
    """Redact all reviewed shards of a folder that pass into another folder; the problems of the others."""
    kept, wrong = passed(shards.read_shards(spark, emails), shards.review_with_lines(spark, reviews), shards.review_of_shards(spark, originals), analyzed(spark, views), shards.load_key(key_file))
    line = F.to_json(F.struct(*[F.col(f"`{c}`") for c in kept.columns if c not in ("shard", "n_lost")]), {"ignoreNullFields": "false"})
    files.write_lines(kept.select(F.concat("shard", F.lit(".jsonl")).alias("file"), F.col("offset").alias("place"), line.alias("line")), out)
    return wrong
