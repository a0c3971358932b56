"""Distinctive terms of groups of texts: class-based TF-IDF over one- and two-word terms."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from askmine.functions.text import TAG, let
from askmine.operators.dedupe import cut

#: Words at most by which pairs are chosen, and what rounding may add to a score.
MOST_WORDS, SLACK = 4096, 1e-8

#: Common English words that are no terms; a list of our own, as the usual ones differ between libraries.
STOP_WORDS = (
    "about above after again against all also am an and any are as at be because been before being below between both but by "
    "can could did do does doing down during each few for from further had has have having he her here hers herself him himself "
    "his how if in into is it its itself just me more most my myself no nor not now of off on once only or other our ours "
    "ourselves out over own same she should so some such than that the their theirs them themselves then there these they this "
    "those through to too under until up very was we were what when where which while who whom why will with would you your "
    "yours yourself yourselves"
).split()


def words(text: Column) -> Column:
    """The words of two letters or more that are no stop words."""
    return F.filter(F.regexp_extract_all(F.lower(F.regexp_replace(text, TAG, " ")), F.lit(r"(?U)\b(\p{L}{2,})\b"), 1), lambda w: ~w.isin(*STOP_WORDS))


def pairs(w: Column) -> Column:
    """The pairs of words that stand together; a null word is in none."""
    both = F.zip_with(F.slice(w, 1, F.size(w) - 1), F.slice(w, 2, F.size(w) - 1), lambda a, b: F.when(a.isNotNull() & b.isNotNull(), F.concat_ws(" ", a, b)))
    return F.when(F.size(w) > 1, F.filter(both, lambda x: x.isNotNull())).otherwise(F.array().cast("array<string>"))


def terms(text: Column) -> Column:
    """The words of a text, and the pairs of those that then stand together."""
    return let(words(text), lambda w: F.concat(w, pairs(w)))


def _counts(texts: DataFrame, group: str, found: Column) -> DataFrame:
    return texts.select(group, F.explode(found).alias("term")).groupBy(group, "term").agg(F.count(F.lit(1)).alias("n_term"))


def top_terms(texts: DataFrame, group: str, text: str, n: int = 8) -> DataFrame:
    """group, rank (from 1), term, n_term: the n terms with the highest share in the group times corpus rarity.

    Equal scores (to nine decimals) are in alphabetical order. Words are counted first. A pair is no more frequent than either
    of its words, and a score has a bound that grows with the term's count, so pairs of a word whose bound lies below the n-th
    score of each group's words are not counted; where more than MOST_WORDS words are left, all pairs are.
    """
    own = F.col(text)
    # the empty word stands for a text with words, which has a pair less than words
    single = cut(_counts(texts, group, let(words(own), lambda w: F.when(F.size(w) > 0, F.concat(w, F.array(F.lit("")))))))
    in_group = single.groupBy(group).agg(F.sum(F.when(F.col("term") == "", -F.col("n_term")).otherwise(2 * F.col("n_term"))).alias("n_group"))
    known = cut(in_group.crossJoin(F.broadcast(in_group.agg(F.avg("n_group").alias("mean")))))  # a row a group
    share = F.col("n_term") / F.col("n_group")

    def scored(counts: DataFrame) -> DataFrame:
        # a term has a row per group at most, so its window is no hot one
        corpus = counts.withColumn("n_corpus", F.sum("n_term").over(W.partitionBy("term"))).join(F.broadcast(known), group)
        return corpus.select(group, "term", "n_term", F.round(share * F.log1p(F.col("mean") / F.col("n_corpus")), 9).alias("score"))

    def ranked(scores: DataFrame) -> DataFrame:
        """Of a group, n rows a task go to the one that ranks it."""
        return scores.withColumn("rank", F.row_number().over(W.partitionBy(group).orderBy(F.col("score").desc(), "term"))).filter(F.col("rank") <= n)

    best = cut(ranked(scored(single.filter("term <> ''"))).drop("rank"))
    least = best.groupBy(group).agg(F.when(F.count(F.lit(1)) == n, F.min("score")).alias("least"))
    bound = share * F.log1p(F.col("mean") / F.col("n_term"))
    may = single.filter("term <> ''").join(F.broadcast(known.join(F.broadcast(least), group)), group).filter(F.col("least").isNull() | (bound >= F.col("least") - SLACK))
    kept = [r["term"] for r in may.select("term").distinct().limit(MOST_WORDS + 1).collect()]
    left = words(own) if len(kept) > MOST_WORDS else F.transform(words(own), lambda w: F.when(w.isin(*kept), w))
    return ranked(best.unionByName(scored(_counts(texts, group, let(left, pairs))))).select(group, "rank", "term", "n_term")


def lowercase_usage(messages: DataFrame, text: str, least: int = 10, english: DataFrame | None = None) -> DataFrame:
    """word, n: words in lower case, counted once per message, of ``least`` messages or more; addresses are cut first.

    english: with it, only words of this table (column word) count.
    """
    plain = F.regexp_replace(F.col(text), r"\S*@\S*|(?i)\bhttps?://\S+|\bwww\.\S+", " ")
    words = F.array_distinct(F.filter(F.regexp_extract_all(plain, F.lit(r"(\p{L}+)"), 1), lambda w: w == F.lower(w)))
    return messages.select(F.explode(words).alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= least).transform(lambda n: n if english is None else n.join(english.select("word").distinct(), "word", "left_semi"))
