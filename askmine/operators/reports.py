"""What people read, as tables of lines (file, place, line) for ``files.write_lines``: nothing is put together on the driver.

A report's lines are numbered by its rows' order and their place within a row; the order is given by columns whose numbers
are small (clusters, candidates) or spread over files (one of a shard, so that no task has them all).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from askmine.functions.text import trimmed


#: How the files begin that name the analyzed messages of a shard.
ANALYZED = "analyzed"


def lines(rows: DataFrame, file: Column, order: list[Column], *parts: Column) -> DataFrame:
    """file, place, line: for each row its parts, which are lines or arrays of lines; a null part gives none."""
    as_array = [p if isinstance(p, Column) and p_is_array else F.array(p) for p, p_is_array in map(_kind, parts)]
    flat = F.filter(F.concat(*[F.coalesce(a, F.array().cast("array<string>")) for a in as_array]), lambda x: x.isNotNull())
    numbered = rows.select(file.alias("file"), *[c.alias(f"_o{i}") for i, c in enumerate(order)], flat.alias("_lines"))
    names = [f"_o{i}" for i in range(len(order))]
    place = F.coalesce(F.sum(F.size("_lines")).over(W.partitionBy("file").orderBy(*names).rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    return numbered.withColumn("_before", place).select("file", "_before", F.posexplode("_lines").alias("_i", "line")).select("file", (F.col("_before") + F.col("_i")).alias("place"), "line")


class Many:
    """A part that is an array of lines."""

    def __init__(self, column: Column):
        self.column = column


def _kind(part) -> tuple[Column, bool]:
    return (part.column, True) if isinstance(part, Many) else (part if isinstance(part, Column) else F.lit(part), False)


def report(summaries: DataFrame, texts: DataFrame, file: str = "report.txt") -> DataFrame:
    """Each cluster with its sizes, terms and typical texts (of describe.with_texts), cut to a line."""
    shown = texts.groupBy("cluster").agg(F.transform(F.array_sort(F.collect_list(F.struct("rank", trimmed(F.col("text")).alias("t")))), lambda s: F.concat(F.lit("  - "), s["t"])).alias("_shown"))
    rows = summaries.join(shown, "cluster", "left")
    head = F.format_string("cluster %d: %d chunks, %d emails, %d threads", "cluster", "n_chunks", "n_emails", "n_threads")
    return lines(rows, F.lit(file), [F.col("cluster")], head, F.concat(F.lit("  terms: "), F.col("top_terms")), Many(F.col("_shown")), F.lit(""))


def table(rows: DataFrame, order: list[str], file: str, *columns: str) -> DataFrame:
    """A header and tab-separated rows: clusters, sweeps, candidates, held-out labels, samples."""
    chosen = list(columns) or rows.columns
    head = rows.sparkSession.createDataFrame([(file, -1, "\t".join(chosen))], "file string, place bigint, line string")
    cells = [F.regexp_replace(F.coalesce(F.col(c).cast("string"), F.lit("")), r"[\t\r\n]+", " ") for c in chosen]
    return head.unionByName(lines(rows, F.lit(file), [F.col(c) for c in order], F.concat_ws("\t", *cells)))


def triage(rows: DataFrame, file: str = "triage.txt") -> DataFrame:
    """Clusters under their decisions, faq first; rows: of clusters.triaged, with cluster and top_terms."""
    place = F.when(F.col("decision") == "faq", 0).when(F.col("decision") == "review", 1).otherwise(2)
    said = F.concat(F.format_string("%s\tcluster %d\t%d chunks\t", F.col("decision"), F.col("cluster"), F.col("n")), F.col("top_terms"), F.when(F.col("reason") != "", F.concat(F.lit("\t("), F.col("reason"), F.lit(")"))).otherwise(F.lit("")))
    return lines(rows, F.lit(file), [place, -F.col("n"), F.col("cluster")], said)


def candidates(summaries: DataFrame, triaged: DataFrame, texts: DataFrame, file: str = "candidates.txt") -> DataFrame:
    """Only the clusters that may become a question of the list, with their typical texts and replies."""
    chosen = summaries.join(triaged.filter("decision = 'faq'").select("cluster"), "cluster", "left_semi")
    return report(chosen, texts, file)


def read_by_hand(chunks: DataFrame, replies: DataFrame, file: str = "read_by_hand.txt") -> DataFrame:
    """Every chunk given, by thread in the order of its first date, each reply once in its thread.

    chunks: chunk_id, thrid, date, text. replies: of describe.next_replies.
    """
    first = chunks.groupBy("thrid").agg(F.min("date").alias("_first"))
    asked = chunks.join(first, "thrid").join(replies, "chunk_id", "left")
    again = F.row_number().over(W.partitionBy("thrid", "reply_id").orderBy("date", "chunk_id"))
    once = asked.withColumn("_reply", F.when(F.col("reply_id").isNotNull() & (again == 1), F.concat(F.lit("  > "), F.col("reply_text"))))
    # a file a month keeps a task's share bounded
    name = F.concat(F.lit(file.removesuffix(".txt") + "-"), F.coalesce(F.substring("_first", 1, 7), F.lit("undated")), F.lit(".txt"))
    return lines(once, name, [F.col("_first"), F.col("thrid"), F.col("date"), F.col("chunk_id")], F.concat(F.lit("=== "), F.col("thrid")), F.col("text"), F.col("_reply"), F.lit(""))


def views(emails: DataFrame, review: DataFrame) -> DataFrame:
    """For each shard all its messages with their redactions in brackets; a signature is one bracket that hides what it holds.

    emails: id, subject, body, shard. Which messages were analyzed is said in files of their own, ANALYZED-<shard>.jsonl (see
    gate.analyzed): a message may say anything, also what looks like the head of another.
    """
    spans = review.filter("decision = 'redact'").groupBy("email_id").agg(
        *[F.collect_list(F.when(F.col("field") == f, F.struct("start", "end", "entity_type"))).alias(f"_{f}") for f in ("subject", "body")]
    )
    named = emails.withColumn("_id", F.coalesce("id", F.lit("")))
    rows = named.join(spans, F.col("_id") == F.col("email_id"), "left")
    shown = {f: bracketed(F.coalesce(F.col(f), F.lit("")), F.col(f"_{f}")) for f in ("subject", "body")}
    texts = lines(rows, F.concat("shard", F.lit(".txt")), [F.col("_id")], F.concat(F.lit("=== "), F.col("_id")), F.concat(F.lit("subject: "), shown["subject"]), shown["body"], F.lit(""))
    ids = lines(named, F.concat(F.lit(f"{ANALYZED}-"), "shard", F.lit(".jsonl")), [F.col("_id")], F.to_json(F.struct(F.col("_id").alias("email_id"))))
    return texts.unionByName(ids)


def bracketed(text: Column, spans: Column) -> Column:
    """A text with [ENTITY: what it says] in place of each span, by one pass over the spans in order."""
    inner = F.filter(F.coalesce(spans, F.array().cast("array<struct<start:int,end:int,entity_type:string>>")), lambda s: s.isNotNull())
    outer = F.filter(inner, lambda s: ~F.exists(inner, lambda o: (o["start"] <= s["start"]) & (s["end"] <= o["end"]) & (o["entity_type"] == "SIGNATURE") & (s["entity_type"] != "SIGNATURE")))
    empty = F.struct(F.lit("").alias("out"), F.lit(0).alias("at"))

    def step(seen: Column, s: Column) -> Column:
        overlaps = s["start"] < seen["at"]
        piece = F.concat(F.substr(text, seen["at"] + 1, s["start"] - seen["at"]), F.lit("["), s["entity_type"], F.lit(": "), F.substr(text, s["start"] + 1, s["end"] - s["start"]), F.lit("]"))
        return F.when(overlaps, seen).otherwise(F.struct(F.concat(seen["out"], piece).alias("out"), s["end"].alias("at")))

    return F.aggregate(F.array_sort(outer), empty, step, lambda seen: F.concat(seen["out"], F.substr(text, seen["at"] + 1, F.length(text))))


def quarantined(hits: DataFrame, file: str = "quarantine.txt") -> DataFrame:
    """Where the tripwire has fired, never on what."""
    return lines(hits, F.lit(file), [F.col("id"), F.col("field"), F.col("start")], F.format_string("%s %s %s %d-%d", "id", "field", "entity_type", "start", "end"))


def word_list(entries: DataFrame, file: str) -> DataFrame:
    """section, entry rows as a list file that recognizers.read_lists reads."""
    named = entries.groupBy("section").agg(F.array_sort(F.collect_list("entry")).alias("_entries"))  # lists are short
    return lines(named, F.lit(file), [F.col("section")], F.concat(F.lit("["), F.col("section"), F.lit("]")), Many(F.col("_entries")), F.lit(""))


def page(summaries: DataFrame, points: DataFrame, file: str = "clusters.html") -> DataFrame:
    """An HTML page of sizes, terms and the map of points (x, y, cluster): never a message's text.

    points: x, y, cluster; their cells of the map are drawn, MAP_CELLS at most, so that the page stays of a size.
    """
    cell = lambda c: F.round(c, 2)
    dots = points.groupBy(cell(F.col("x")).alias("x"), cell(F.col("y")).alias("y")).agg(F.mode("cluster").alias("cluster"), F.count(F.lit(1)).alias("n"))
    most = dots.orderBy(F.col("n").desc(), "x", "y").limit(MAP_CELLS)
    colour = F.format_string("hsl(%d,60%%,45%%)", (F.col("cluster") * 47) % 360)
    circle = F.concat(F.lit("<circle r='.01' cx='"), F.col("x").cast("string"), F.lit("' cy='"), F.col("y").cast("string"), F.lit("' fill='"), F.when(F.col("cluster") < 0, "#ccc").otherwise(colour), F.lit("'/>"))
    escaped = lambda c: F.replace(F.replace(F.replace(c, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))
    row = F.concat(F.lit("<tr><td>"), F.col("cluster").cast("string"), F.lit("<td>"), F.col("n_chunks").cast("string"), F.lit("<td>"), F.col("n_threads").cast("string"), F.lit("<td>"), escaped(F.col("top_terms")))
    spark = summaries.sparkSession
    fixed = [(0, 0, "<!doctype html><meta charset=utf-8><title>Clusters</title><h1>Clusters</h1><svg viewBox='-1 -1 2 2' width=600>"), (2, 0, "</svg><table><tr><th>cluster<th>chunks<th>threads<th>terms"), (4, 0, "</table>")]
    parts = spark.createDataFrame(fixed, "part int, place bigint, line string")
    parts = parts.unionByName(lines(most, F.lit(file), [F.col("x"), F.col("y")], circle).select(F.lit(1).alias("part"), "place", "line"))
    parts = parts.unionByName(lines(summaries, F.lit(file), [-F.col("n_chunks"), F.col("cluster")], row).select(F.lit(3).alias("part"), "place", "line"))
    return parts.select(F.lit(file).alias("file"), (F.col("part").cast("bigint") * (1 << 40) + F.col("place")).alias("place"), "line")


#: Cells of a map that a page draws.
MAP_CELLS = 20_000
