"""Describing clusters of chunks: sizes, typical texts, distinctive terms, and how such questions were answered."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from askmine.functions.text import dedupe_key, message_time
from askmine.operators import clusters, terms

#: Typical texts, terms and replies of a cluster.
TYPICAL, TERMS, REPLIES = 5, 8, 2


def sizes(chunks: DataFrame, cluster: str = "cluster", id_: str = "id", thread: str = "thrid") -> DataFrame:
    """cluster, n_chunks, n_emails, n_threads: copies count."""
    return chunks.groupBy(cluster).agg(F.count(F.lit(1)).alias("n_chunks"), F.count_distinct(id_).alias("n_emails"), F.count_distinct(thread).alias("n_threads"))


def distinct_texts(chunks: DataFrame, text: str, position: Column, *by: str) -> DataFrame:
    """Of chunks with one text (up to case and white space) in a group the first by position."""
    digest = F.sha2(dedupe_key(F.coalesce(F.col(text), F.lit(""))), 256)
    named = chunks.select(*by, digest.alias("_digest"), F.struct(position.alias("_at"), *[F.col(c) for c in chunks.columns if c not in by]).alias("_row"))
    first = named.groupBy(*by, "_digest").agg(F.min_by("_row", F.col("_row._at")).alias("_row"))
    return first.select(*by, "_row.*").drop("_at")


def typical(chunks: DataFrame, cluster: str = "cluster", key: str = "chunk_id", text: str = "text", vector: str = "embedding", n: int = TYPICAL) -> DataFrame:
    """cluster, rank, key of the n distinct texts nearest to the mean direction of the cluster's distinct texts."""
    return clusters.representatives(distinct_texts(chunks.select(cluster, key, text, vector), text, F.col(key), cluster), key, cluster, vector, n)


def next_replies(asked: DataFrame, outbound: DataFrame, thread: str = "thrid", date: str = "date", key: str = "chunk_id", index: str = "chunk_index") -> DataFrame:
    """key of a question, and reply_id and reply_text: the thread's first outbound chunk strictly later.

    One window over the merged timeline. Undated questions have none, undated replies answer none.
    """
    line = lambda df, asks: df.select(F.col(thread).alias("_t"), F.unix_micros(message_time(F.col(date))).alias("_at"), F.col(index).alias("_i"), F.col(key).alias("_key"), "text", F.lit(asks).alias("_asks"))
    both = line(asked, True).unionByName(line(outbound, False)).filter("_at is not null")
    later = W.partitionBy("_t").orderBy("_at").rangeBetween(1, W.unboundedFollowing)
    reply = F.min(F.when(~F.col("_asks"), F.struct("_at", "_i", F.col("_key").alias("id"), "text"))).over(later)
    found = both.withColumn("_r", reply).filter("_asks and _r is not null")
    return found.select(F.col("_key").alias(key), F.col("_r.id").alias("reply_id"), F.col("_r.text").alias("reply_text"))


def replies_for(reps: DataFrame, replies: DataFrame, cluster: str = "cluster", key: str = "chunk_id", most: int = REPLIES) -> DataFrame:
    """cluster, reply_rank, reply_id, reply_text: the replies to a cluster's typical texts, in their order, each text once.

    reps: cluster, rank, key. replies: of next_replies.
    """
    ordered = reps.join(replies, key).select(cluster, "rank", "reply_id", "reply_text")
    first = distinct_texts(ordered, "reply_text", F.col("rank"), cluster)
    place = F.row_number().over(W.partitionBy(cluster).orderBy("rank"))  # a cluster has TYPICAL replies at most
    return first.withColumn("reply_rank", place).filter(F.col("reply_rank") <= most).select(cluster, "reply_rank", "reply_id", "reply_text")


def joined(chunks: DataFrame, assignments: DataFrame, key: str = "chunk_id") -> DataFrame:
    """Chunks with their clusters; both must name the same chunks (see shards.refuse_stale)."""
    return chunks.join(assignments, key)


def described(chunks: DataFrame, outbound: DataFrame, cluster: str = "cluster") -> DataFrame:
    """A row a cluster but the noise: sizes, top_terms ("; " between them), representatives and replies (ids, " " between them).

    chunks: chunk_id, id, thrid, date, chunk_index, text, embedding, cluster. outbound: the same but for the last two.
    """
    kept = chunks.filter(F.col(cluster) >= 0)
    reps = typical(kept, cluster)
    asked = kept.join(reps.select("chunk_id"), "chunk_id", "left_semi")
    replies = replies_for(reps, next_replies(asked, outbound), cluster)
    listed = lambda df, rank, value, glue: df.groupBy(cluster).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(rank, value))), lambda s: s[value]), glue).alias("_x"))
    named = terms.top_terms(kept, cluster, "text", TERMS)
    out = sizes(kept, cluster)
    for table, rank, value, glue, name in ((named, "rank", "term", "; ", "top_terms"), (reps, "rank", "chunk_id", " ", "representatives"), (replies, "reply_rank", "reply_id", " ", "replies")):
        out = out.join(listed(table, rank, value, glue), cluster, "left").withColumnRenamed("_x", name)
    return out.fillna("", ["top_terms", "representatives", "replies"])


def with_texts(summaries: DataFrame, chunks: DataFrame, column: str = "representatives", key: str = "chunk_id") -> DataFrame:
    """cluster, rank, key, text of the chunks that a summary's column names, in its order."""
    named = summaries.select("cluster", F.posexplode(F.filter(F.split(column, " "), lambda x: x != "")).alias("rank", key))
    return named.join(chunks.select(key, "text"), key).select("cluster", (F.col("rank") + 1).alias("rank"), key, "text")
