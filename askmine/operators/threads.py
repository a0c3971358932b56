"""Threads: the first answer to a question, the first client message, and who is one's own sender."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from askmine.functions import text, tripwire
from askmine.operators import similar


def with_first_reply(messages: DataFrame, thread: str, time: str, position: str, is_question: Column, is_reply: Column) -> DataFrame:
    """Questions with reply, the position and time of the thread's first reply strictly later; null if there is none.

    One window over the merged timeline instead of a join of each question with all later replies. Undated messages
    neither ask nor answer.
    """
    known = messages.filter(F.col(time).isNotNull())
    order = W.partitionBy(thread).orderBy(F.col(time))
    later = order.rangeBetween(1, W.unboundedFollowing) if dict(messages.dtypes)[time] in ("bigint", "int") else None
    stamped = known if later is not None else known.withColumn("_micros", F.unix_micros(time))
    window = later or W.partitionBy(thread).orderBy("_micros").rangeBetween(1, W.unboundedFollowing)
    answer = F.min(F.when(is_reply, F.struct(F.col(time).alias("time"), F.col(position).alias("position")))).over(window)
    asked = stamped.withColumn("reply", answer).filter(is_question)
    return asked if later is not None else asked.drop("_micros")


def first_client_message(emails: DataFrame, own: DataFrame) -> DataFrame:
    """For each thread its test query or the reason why it has none: thrid, id, kind, lang, reason.

    emails: id, thrid, date, direction, sender, subject, body. own: sender, of one's own outbound mail. A thread with an
    undated message has none, as nobody can tell who wrote first.
    """
    own = own.select("sender").where("sender is not null and sender <> ''").distinct().withColumn("_own", F.lit(True))
    rows = emails.join(own, "sender", "left").withColumn("_at", text.message_time(F.col("date"))).withColumn("thrid", F.coalesce("thrid", F.lit("")))
    order = W.partitionBy("thrid").orderBy("_at", "id")
    sent_before = F.coalesce(F.max(F.when(F.col("direction") == "outbound", 1)).over(order.rowsBetween(W.unboundedPreceding, -1)), F.lit(0)) == 1
    client = (F.col("direction") == "inbound") & F.col("_own").isNull()
    body = F.coalesce(F.col("body"), F.lit(""))
    subject = F.coalesce(F.col("subject"), F.lit(""))
    own_words = text.without_flat_quote(body)
    reason = (
        F.when(text.is_reply(subject), "reply")
        .when(text.is_auto_reply(subject, own_words), "auto_reply")
        .when(tripwire.fires_any(subject) | tripwire.fires_any(body), "tripwire")
        .when(~text.has_content(own_words), "no_content")
        .otherwise("")
    )
    marked = rows.withColumn("_first", F.when(client, F.struct("_at", "id", F.when(sent_before, "follow_up").otherwise("opener").alias("kind"), F.when(text.is_vietnamese(own_words), "vi").otherwise("en").alias("lang"), own_words.alias("text"), reason.alias("reason"))))
    first = marked.groupBy("thrid").agg(F.min("_first").alias("f"), F.bool_and(F.col("_at").isNotNull()).alias("dated"))
    why = F.when(~F.col("dated"), "undated").when(F.col("f").isNull(), "no_client_email").otherwise(F.col("f.reason"))
    return first.select("thrid", why.alias("reason"), "f.id", "f.kind", "f.lang", "f.text")


def with_near_duplicates_named(picked: DataFrame, emails: DataFrame) -> DataFrame:
    """picked (of first_client_message), where a test query's reason is near_duplicate if a message of another thread holds most of its own words."""
    body = F.coalesce(F.col("body"), F.lit(""))
    own = emails.select("id", F.coalesce("thrid", F.lit("")).alias("thrid"), text.without_flat_quote(body).alias("text"))
    found = similar.near_duplicates(picked.filter("reason = ''").select("id"), own, "id", "thrid", "text").select("id", F.lit(True).alias("_twin"))
    return picked.join(found, "id", "left").withColumn("reason", F.when((F.col("reason") == "") & F.col("_twin"), "near_duplicate").otherwise(F.col("reason"))).select(*picked.columns)


def without_own_unsent(emails: DataFrame) -> DataFrame:
    """Inbound rows whose sender never sent outbound mail, and all others; the senders are as many as they are."""
    own = emails.filter((F.col("direction") == "outbound") & (F.coalesce("sender", F.lit("")) != "")).select("sender").distinct()
    inbound = F.col("direction") == "inbound"
    return emails.filter(inbound).join(own, "sender", "left_anti").select(*emails.columns).unionByName(emails.filter(~inbound | F.col("direction").isNull()))


def leaks(texts: DataFrame, text_column: str, ids: DataFrame, id_column: str, pattern: str = r"\b[0-9a-f]{16,20}\b") -> DataFrame:
    """Rows of texts with each held-out id that their text names as a token."""
    tokens = texts.withColumn("token", F.explode(F.array_distinct(F.regexp_extract_all(F.col(text_column), F.lit(f"({pattern})"), 1))))
    return tokens.join(ids.select(F.col(id_column).cast("string").alias("token")).distinct(), "token", "left_semi")
