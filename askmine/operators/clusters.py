"""Describing clusters: sizes, ranks, typical members, shares, triage."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from askmine.functions import text as t
from askmine.functions.decisions import triage

#: Strings of the website's form, and words left over from markup.
FORM_MARKERS = ("Date/Time of Event", "Message (Please", "Day of Contact", "Total: $")
MARKUP_WORDS = ("div", "span", "br", "font", "face", "aptos", "calibri", "style", "margin", "nbsp", "line", "height", "size")


def ranked_by_size(assignments: DataFrame, cluster: str) -> DataFrame:
    """cluster, n, new_cluster: 0 for the largest, equal ones by their old number; noise (below 0) stays -1."""
    sizes = assignments.groupBy(cluster).agg(F.count(F.lit(1)).alias("n"))
    rank = F.row_number().over(W.partitionBy(F.col(cluster) < 0).orderBy(F.col("n").desc(), cluster)) - 1
    return sizes.withColumn("new_cluster", F.when(F.col(cluster) < 0, F.lit(-1)).otherwise(rank))


def representatives(vectors: DataFrame, key: str, cluster: str, vector: str, n: int = 5) -> DataFrame:
    """cluster, rank (from 1), key of the n members nearest to the mean direction of their cluster; ties by key."""
    cells = vectors.select(cluster, F.posexplode(F.col(vector)).alias("i", "x"))
    means = cells.groupBy(cluster, "i").agg(F.avg(F.col("x").cast("double")).alias("m"))
    centre = means.groupBy(cluster).agg(F.transform(F.array_sort(F.collect_list(F.struct("i", "m"))), lambda s: s["m"]).alias("centre"))
    dot = F.aggregate(F.zip_with(vector, "centre", lambda a, b: a.cast("double") * b), F.lit(0.0), lambda a, b: a + b)
    near = vectors.join(centre, cluster).select(cluster, key, F.round(dot, 9).alias("dot"))
    order = W.partitionBy(cluster).orderBy(F.col("dot").desc(), key)
    return near.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= n).select(cluster, "rank", key)


def signals(texts: DataFrame, cluster: str, text: str, top: DataFrame) -> DataFrame:
    """cluster, n, how many texts ask, are Vietnamese, hold a form or a footer, and how many top terms are markup."""
    c = F.col(text)
    count = lambda holds: F.count(F.when(holds, 1))
    form = F.lit(False)
    for marker in FORM_MARKERS:
        form = form | c.contains(marker)
    counts = texts.groupBy(cluster).agg(F.count(F.lit(1)).alias("n"), count(c.contains("?")).alias("n_question"), count(t.is_vietnamese(c)).alias("n_vietnamese"), count(form).alias("n_template"), count(t.has_footer_notice(c)).alias("n_footer"))
    is_markup = F.forall(F.split("term", " "), lambda w: w.isin(*MARKUP_WORDS))
    markup = top.groupBy(cluster).agg(count(is_markup).alias("markup_terms"))
    return counts.join(markup, cluster, "left").fillna(0, ["markup_terms"])


def triaged(measured: DataFrame) -> DataFrame:
    """signals with decision and reason."""
    share = lambda c: F.col(c) / F.greatest(F.col("n"), F.lit(1))
    made = triage(share("n_question"), share("n_vietnamese"), share("n_template"), share("n_footer"), F.col("markup_terms"))
    return measured.withColumn("_t", made).select("*", "_t.decision", "_t.reason").drop("_t")
