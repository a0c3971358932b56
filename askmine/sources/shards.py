"""JSON-lines shards, review files and manifests: the interchange formats, and what guards them."""

from __future__ import annotations

import json
import os
import secrets

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from askmine.sources import quoted
from askmine.sources.files import write_lines

SHARD_ROWS = 2000
EMAIL = (
    "id string, thrid string, date string, direction string, labels array<string>, `from` string, sender string, is_automated boolean, `to` string, subject string, body string, "
    "n_words int, body_source string, n_attachments int, attachments array<struct<filename:string,content_type:string,approx_bytes:bigint>>, offset bigint"
)
CHUNK = (
    "chunk_id string, id string, thrid string, date string, direction string, subject string, chunk_index int, n_chunks int, n_words int, text string, task string, model string, embedding array<float>"
)
REVIEW = "email_id string, thrid string, field string, entity_type string, start int, end int, text string, context string, score double, recognizer string, decision string, rule string, note string"
#: How review files are written and read back.
CSV = {"header": "true", "quote": '"', "escape": '"', "multiLine": "true", "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false", "nullValue": "", "emptyValue": '""'}


def read_shards(spark: SparkSession, folder: str, schema: str = EMAIL, skip: list[str] = ()) -> DataFrame:
    """Rows of emails-*.jsonl with their shard's name, without shards that are done."""
    rows = spark.read.schema(schema).json(f"{folder}/emails-*.jsonl").withColumn("shard", F.regexp_extract("_metadata.file_name", r"^(.*)\.jsonl$", 1))
    return rows.filter(~F.col("shard").isin(*skip)) if skip else rows


def with_shard(rows: DataFrame, order: str, size: int = SHARD_ROWS, range_rows: int = 100_000) -> DataFrame:
    """rows with shard, numbered in the order of ``order``.

    Rows are counted in ranges of the order first, of about range_rows by a sample of it, so that only the ranges' counts pass
    one task, however the order's values lie.
    """
    from askmine.operators.dedupe import cut

    n_ranges = max(1, rows.count() // range_rows)
    ranged = rows.withColumn("_range", F.lit(0)) if n_ranges == 1 else cut(rows.repartitionByRange(n_ranges, order).withColumn("_range", F.spark_partition_id()))
    counts = ranged.groupBy("_range").count()
    before = counts.withColumn("_before", F.coalesce(F.sum("count").over(W.orderBy("_range").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))).drop("count")
    number = F.col("_before") + F.row_number().over(W.partitionBy("_range").orderBy(order)) - 1
    return ranged.join(F.broadcast(before), "_range").withColumn("shard", F.format_string("emails-%05d", F.floor(number / size).cast("int"))).drop("_range", "_before")


def write_shards(rows: DataFrame, folder: str, order: str, size: int = SHARD_ROWS) -> None:
    """Files emails-00000.jsonl and so on, which read_shards reads back; each is whole or absent."""
    numbered = with_shard(rows, order, size)
    line = F.to_json(F.struct(*[F.col(f"`{c}`") for c in rows.columns]), {"ignoreNullFields": "false"})
    write_lines(numbered.select(F.concat("shard", F.lit(".jsonl")).alias("file"), F.col(order).alias("place"), line.alias("line")), folder)


def read_review(spark: SparkSession, path: str) -> DataFrame:
    """Review rows with the shard that their file is of."""
    return spark.read.schema(REVIEW).options(**CSV).csv(path)


def review_of_shards(spark: SparkSession, folder: str) -> DataFrame:
    """Review rows of a folder of emails-*.csv with their shard, as emails-00000."""
    rows = read_review(spark, f"{folder}/emails-*.csv")
    return rows.withColumn("shard", F.regexp_extract("_metadata.file_name", r"^(.*)\.csv$", 1))


def review_with_lines(spark: SparkSession, folder: str) -> DataFrame:
    """The same with the line of its file that each row starts on, which says an editor where to look."""
    rows = quoted.with_header(quoted.read(spark, folder), REVIEW)
    return rows.withColumn("shard", F.regexp_extract("file", r"(emails-[^/]*)\.csv$", 1)).filter("shard <> ''").drop("file")


def write_review(rows: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Review rows as CSV files in the order of their messages; every file begins with the header."""
    columns = [F.col(c.split(" ")[0]) for c in REVIEW.split(", ")]
    ordered = rows.select(columns).repartitionByRange("email_id", "field", "start").sortWithinPartitions("email_id", "field", "start")
    ordered.write.mode(mode).options(**CSV).csv(path)


def append_review(rows: DataFrame, path: str) -> None:
    """More rows beside those of a review, whose files stay as their editors left them."""
    write_review(rows, path, "append")


def unedited(spark: SparkSession, review: str, original: str) -> bool:
    """Whether a review still is what was written first: only then may it be written anew. No original, no leave."""
    try:
        a, b = read_review(spark, review), read_review(spark, original)
    except AnalysisException:
        return False
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def load_key(path: str) -> bytes:
    """The key of the keyed hashes: 64 hex digits, made once and readable by the owner only. It is never shown."""
    try:
        with open(path, encoding="ascii") as f:
            return f.read().strip().encode()
    except FileNotFoundError:
        os.makedirs(os.path.dirname(os.path.abspath(path)), exist_ok=True)
        with os.fdopen(os.open(path, os.O_WRONLY | os.O_CREAT | os.O_EXCL, 0o600), "w", encoding="ascii") as f:
            f.write(secrets.token_hex(32))
        return load_key(path)


class Position:
    """How far a run has come: saved as JSON, cleared at its end; what can't be read means a new start."""

    def __init__(self, path: str):
        self.path = path

    def load(self) -> dict:
        return read_manifest(self.path) or {}

    def save(self, **where) -> None:
        write_text(self.path, json.dumps(where))

    def clear(self) -> None:
        if os.path.exists(self.path):
            os.remove(self.path)


def english_words(spark: SparkSession, path: str) -> DataFrame:
    """word: the entries of a dictionary that it writes in lower case."""
    word = F.trim("value")
    return spark.read.text(path).select(word.alias("word")).filter((F.col("word") != "") & (F.col("word") == F.lower("word"))).distinct()


def remember_seen(rows: DataFrame, strong: Column, fingerprint: Column, folder: str) -> None:
    """Add the ids and fingerprints of accepted rows to a log that later runs read."""
    rows.select(strong.alias("id"), fingerprint.alias("fingerprint")).write.mode("append").parquet(folder)


def unseen(rows: DataFrame, strong: Column, fingerprint: Column, folder: str) -> DataFrame:
    """rows with drop_reason: dup_id or dup_body if an earlier run has accepted the id or the fingerprint, else null."""
    spark = rows.sparkSession
    try:
        log = spark.read.schema("id string, fingerprint string").parquet(folder)
    except AnalysisException:
        return rows.withColumn("drop_reason", F.lit(None).cast("string"))
    ids = log.select(F.col("id").alias("_id"), F.lit(True).alias("_old_id")).filter("_id <> ''").distinct()
    prints = log.select(F.col("fingerprint").alias("_print"), F.lit(True).alias("_old_print")).distinct()
    marked = rows.withColumns({"_id": strong, "_print": fingerprint}).join(ids, "_id", "left").join(prints, "_print", "left")
    return marked.withColumn("drop_reason", F.when(F.col("_old_id"), "dup_id").when(F.col("_old_print"), "dup_body")).select(*rows.columns, "drop_reason")


def write_text(path: str, text: str) -> None:
    """A small report of the driver's, whole or not at all."""
    with open(path + ".part", "w", encoding="utf-8", newline="") as f:
        f.write(text)
    os.replace(path + ".part", path)


def read_manifest(path: str) -> dict | None:
    """A run's manifest; an unreadable one counts as absent."""
    try:
        with open(path, encoding="utf-8") as f:
            return json.load(f)
    except (OSError, ValueError):
        return None


def same_settings(path: str, settings: dict, force: bool = False) -> None:
    """Refuse to add to the output of other settings, unless forced; then note the settings."""
    old = read_manifest(path)
    if old is not None and old.get("config", settings) != settings and not force:
        raise ValueError(f"{path} was made with {old['config']}, not {settings}")
    write_text(path, json.dumps({"config": settings}, indent=2))


def one_kind(chunks: DataFrame, task: str = "clustering") -> str:
    """The model of the chunks, which must be of one model and of the task."""
    kinds = [(r["task"], r["model"]) for r in chunks.select("task", "model").distinct().limit(10).collect()]
    if len(kinds) != 1 or kinds[0][0] != task:
        raise ValueError(f"chunks of {sorted(map(str, kinds))}; one model's {task} vectors are needed")
    return kinds[0][1]


def refuse_stale(assignments: DataFrame, chunks: DataFrame, key: str = "chunk_id") -> None:
    """Both must name the same chunks, and the same models where both have them."""
    a, b = assignments.select(key), chunks.select(key)
    if not a.exceptAll(b).isEmpty() or not b.exceptAll(a).isEmpty():
        raise ValueError("the assignments are of other chunks: cluster again")
    if "model" in assignments.columns and "model" in chunks.columns:
        own, other = (sorted(str(r["model"]) for r in df.select("model").distinct().limit(10).collect()) for df in (assignments, chunks))
        if own != other:
            raise ValueError(f"the assignments are of {own}, the chunks of {other}: cluster again")
