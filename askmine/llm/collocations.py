"""Collocations: phrases whose words keep company more than their parts' counts foretell, by language.

All n-grams of 1 to max_n words are exploded into rows and counted by hash aggregates per language. Those of one and two
words are counted together: each place gives a row of two words (of one at a piece's end), and what these rows come to is
exploded again into the phrase and its first word. Words that are too rare are counted as one, the empty phrase, so that the
count of all words stays known. Phrases are joined with the counts of their prefixes and suffixes, scored in decimals, and those that nearly always lie inside a phrase of one
word more go. (A longer phrase that lies around a candidate holds one of one word more, which is at least as frequent.)

From three words on, rows are dropped before the shuffle whose first or last n - 1 words can't be frequent enough: the
frequent phrases of n - 1 words set bits in a table of BITS_ROWS x 64 bits, which goes to all tasks. A bit that another
phrase has set lets a row through in vain; none is lost, so counts are exact whatever the table's fill.

A null text has no words, a null language is ``und``. Texts and pieces of any length are taken whole, a long piece in runs
of RUN words. Repeated rows count each. Ties go by frequency, then by the phrase's bytes, so the order is total. An empty
table gives no rows. Only the two named columns are read, whatever others there are.
"""

from __future__ import annotations

from functools import reduce
from string import ascii_lowercase, ascii_uppercase

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from askmine.llm.base import checkpointed, joined_hot, quoted

#: Rows of 64 bits that say which phrases may be frequent (16 MB at most).
BITS_ROWS = 1 << 20
#: Bytes from which a piece is long, and words of it that are exploded at a time.
LONG, RUN = 1 << 16, 1024
#: Groups in which a language's phrases are ranked before they meet.
SALTS = 64
#: Arithmetic on counts: products of two have 38 digits at most.
COUNT, WIDE = "decimal(19,0)", "decimal(38,0)"


def pieces(docs: DataFrame, max_n: int, lang: str = "lang", text: str = "text") -> DataFrame:
    """lang, piece, own: the pieces, with one space between words, and the runs of long ones.

    All words of a piece start phrases (own is null). In a run only ``own`` words do; the max_n - 1 after them start those of
    the next run.
    """
    lower = F.translate(F.coalesce(F.col(quoted(text)).cast("string"), F.lit("")), ascii_uppercase + "\t", ascii_lowercase + " ")
    single = F.when(F.contains("lower", F.lit("  ")), F.regexp_replace("lower", " {2,}", " ")).otherwise(F.col("lower"))
    part = lambda piece, own: F.struct(piece.alias("piece"), own.cast("int").alias("own"))

    def run(words: Column, at: Column) -> Column:
        return part(F.concat_ws(" ", F.slice(words, at + 1, RUN + max_n - 1)), F.when(at + RUN < F.size(words), F.lit(RUN)))

    def runs(piece: Column) -> Column:
        cut = lambda words: F.transform(F.sequence(F.lit(0), F.size(words) - 1, F.lit(RUN)), lambda at: run(words, at))
        return F.flatten(F.transform(F.array(F.split(F.trim(piece), " ")), cut))

    cut = F.transform(F.split(single, r"[.,;:!?\x0A-\x0D]"), lambda p: F.when(F.octet_length(p) < LONG, F.array(part(p, F.lit(None)))).otherwise(runs(p)))
    named = docs.select(F.coalesce(F.col(quoted(lang)).cast("string"), F.lit("und")).alias("lang"), lower.alias("lower"))
    return named.select("lang", F.explode(F.flatten(cut)).alias("part")).select("lang", "part.*")


def exploded(cut: DataFrame, n: int) -> DataFrame:
    """lang, phrase: a row per place that a phrase of n words starts at; for n = 2, also one per word that ends a piece.

    One expression finds them all: it looks ahead over n words, and goes on by one.
    """
    ahead = "[^ ]++(?: [^ ]++)?+" if n == 2 else " ".join(["[^ ]++"] * n)
    all_ = F.regexp_extract_all("piece", F.lit(f"(?=({ahead}))[^ ]++"), F.lit(1))
    return cut.select("lang", F.explode(F.when(F.col("own").isNull(), all_).otherwise(F.slice(all_, 1, F.col("own")))).alias("phrase"))


def _counted(rows: DataFrame) -> DataFrame:
    return rows.groupBy("lang", "phrase").agg(F.count(F.lit(1)).alias("f"))


def _with_first_words(pairs: DataFrame, min_count: int) -> DataFrame:
    """The counts of pairs, of the words that start them, and of all rare words together, as the empty phrase."""
    as_row = lambda phrase: F.struct(phrase.alias("phrase"), F.col("f").alias("f"))
    word, is_pair = F.substring_index("phrase", " ", 1), (F.col("f") >= min_count) & F.contains("phrase", F.lit(" "))
    each = F.when(is_pair, F.array(as_row(word), as_row(F.col("phrase")))).otherwise(F.array(as_row(word)))
    summed = lambda rows: rows.groupBy("lang", "phrase").agg(F.sum("f").alias("f"))
    counted = summed(pairs.select("lang", F.explode(each).alias("row")).select("lang", "row.*"))
    return summed(counted.withColumn("phrase", F.when(F.col("f") >= min_count, F.col("phrase")).otherwise("")))


def _place(phrase: Column) -> tuple[Column, Column]:
    """Row and bit of a phrase in the table of bits."""
    h = F.xxhash64("lang", phrase)
    return F.pmod(h, F.lit(BITS_ROWS)), F.shiftright(h, 40).bitwiseAND(63).cast("int")


def _bits(frequent: DataFrame) -> DataFrame:
    at, bit = _place(F.col("phrase"))
    return frequent.select(at.alias("at"), bit.alias("bit")).groupBy("at").agg(F.bit_or(F.expr("shiftleft(1L, bit)")).alias("bits"))


def _may_be_frequent(rows: DataFrame, part: Column, bits: DataFrame) -> DataFrame:
    at, bit = _place(part)
    joined = rows.withColumns({"at": at, "bit": bit}).join(F.broadcast(bits), "at")
    return joined.filter(F.getbit("bits", F.col("bit")) == 1).select(*rows.columns)


def _first(k: str) -> Column:
    """The first k words of a phrase, and (below) those after them."""
    return F.expr(f"substring_index(phrase, ' ', {k})")


def _rest(k: str) -> Column:
    if k == "1":
        return F.expr("substring(phrase, instr(phrase, ' ') + 1)")
    return F.expr(f"substring(phrase, length(substring_index(phrase, ' ', {k})) + 2)")


def counts(docs: DataFrame, max_n: int = 3, min_count: int = 10, lang: str = "lang", text: str = "text") -> DataFrame:
    """lang, phrase, f (its occurrences), n_words of all phrases of 1 to max_n words (2 at least) that occur min_count times or more.

    The empty phrase, of 0 words, has the count of all words of its language that are rarer.
    """
    levels = [checkpointed(_with_first_words(_counted(exploded(pieces(docs, max_n, lang, text), 2)), min_count))]
    sized = lambda rows: rows.withColumn("n_words", F.when(F.col("phrase") == "", 0).otherwise(F.size(F.split("phrase", " "))))
    for n in range(3, max_n + 1):
        bits = _bits(sized(levels[-1]).filter(F.col("n_words") == n - 1))
        rows = exploded(pieces(docs, max_n, lang, text), n)
        for part in (_first(str(n - 1)), _rest("1")):
            rows = _may_be_frequent(rows, part, bits)
        levels.append(checkpointed(_counted(rows).filter(F.col("f") >= min_count)))
    return sized(reduce(DataFrame.union, levels))


def scored(grams: DataFrame) -> DataFrame:
    """lang, phrase, a, l, r, score of all phrases of two words or more: by the cut that scores lowest, then the first.

    The two parts of each cut are looked up in one join; a word with which very many phrases begin or end goes by broadcast.
    """
    phrases = grams.filter("n_words > 1").select("lang", "phrase", F.col("f").alias("a"), F.explode(F.sequence(F.lit(1), F.col("n_words") - 1)).alias("k"))
    side = lambda is_left, part: F.struct(F.lit(is_left).alias("is_left"), F.struct("lang", part.alias("phrase")).alias("part"))
    parts = checkpointed(phrases.select("*", F.explode(F.array(side(True, _first("k")), side(False, _rest("k")))).alias("side")).select("lang", "phrase", "a", "k", "side.*"))
    known = grams.select(F.struct("lang", "phrase").alias("part"), "f")
    times = parts.groupBy("part").agg(F.count(F.lit(1)).alias("times"))
    found = joined_hot(parts, times.join(known, "part"), "part", parts.count(), "times")
    cuts = found.groupBy("lang", "phrase", "k").agg(F.first("a").alias("a"), F.max(F.when(F.col("is_left"), F.col("f"))).alias("l"), F.max(F.when(~F.col("is_left"), F.col("f"))).alias("r"))
    cuts = cuts.withColumn("score", F.expr(f"cast(cast(1000000 as decimal(7,0)) * cast(a as {COUNT}) * cast(a as {COUNT}) as {WIDE}) div cast(cast(l as {COUNT}) * cast(r as {COUNT}) as {WIDE})"))
    best = cuts.groupBy("lang", "phrase").agg(F.min(F.struct("score", "k", "a", "l", "r")).alias("best"))
    return best.select("lang", "phrase", "best.a", "best.l", "best.r", "best.score")


def maximal(phrases: DataFrame, grams: DataFrame, drop_percent: int = 50) -> DataFrame:
    """phrases without those of which drop_percent or more of the occurrences lie inside one phrase of one word more."""
    longer = grams.filter("n_words > 2").select("lang", "f", F.explode(F.array(_first("n_words - 1"), _rest("1"))).alias("phrase"))
    most = longer.groupBy("lang", "phrase").agg(F.max("f").alias("f"))
    gone = (phrases["lang"] == most["lang"]) & (phrases["phrase"] == most["phrase"]) & (100 * most["f"] >= drop_percent * phrases["a"])
    return phrases.join(most, gone, "left_anti")


def collocations(docs: DataFrame, max_n: int = 3, min_count: int = 10, drop_percent: int = 50, top: int = 2000, lang: str = "lang", text: str = "text") -> DataFrame:
    """lang, rank (from 1), phrase, a, l, r, n, score: each language's top phrases by score, frequency and bytes."""
    grams = checkpointed(counts(docs, max_n, min_count, lang, text))
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    salted = Window.partitionBy("lang", F.pmod(F.xxhash64("phrase"), F.lit(SALTS))).orderBy(*order)
    some = maximal(scored(grams), grams, drop_percent).withColumn("rank", F.row_number().over(salted)).filter(F.col("rank") <= top)
    ranked = some.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).filter(F.col("rank") <= top)
    words = grams.filter("n_words < 2").groupBy("lang").agg(F.sum("f").alias("n"))
    return ranked.join(words, "lang").select("lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "l", "r", "n", "score")
