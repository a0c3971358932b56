"""Messages that share most of their rare word runs with another thread's message."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from askmine.functions.text import shingles
from askmine.operators.dedupe import cut

#: Words of a run, messages above which a run is boilerplate, and the share that makes a near-duplicate.
RUN_WORDS, BOILERPLATE, SHARE = 5, 20, 0.5
#: Messages, about, among which the most frequent runs are looked for.
SOME = 4096


def run_frequencies(messages: DataFrame, key: str, text: str, size: int = RUN_WORDS) -> DataFrame:
    """run, n: how many messages hold each run of words."""
    return messages.select(key, F.explode(shingles(F.col(text), size)).alias("run")).groupBy("run").agg(F.count(F.lit(1)).alias("n"))


def run_counts(messages: DataFrame, text: str, size: int = RUN_WORDS) -> DataFrame:
    """first, second, n: as run_frequencies, with 96 bits of hash for each run, which take less to shuffle than its text.

    Two of a thousand million runs share them with a probability below 1e-10.
    """
    runs = messages.select(F.explode(shingles(F.col(text), size)).alias("run"))
    return runs.groupBy(F.xxhash64("run").alias("first"), F.hash("run").alias("second")).agg(F.count(F.lit(1)).alias("n"))


def near_duplicates(queries: DataFrame, messages: DataFrame, key: str, thread: str, text: str, boilerplate: int = BOILERPLATE, share: float = SHARE) -> DataFrame:
    """key, twin (in another thread, sharing most rare runs; the smaller key of equals), n_shared, n_rare of near-duplicates.

    Runs in more than ``boilerplate`` messages pair none. A run is shuffled once, as a hash with its message's key. Runs that have
    the same messages become one row with their number before they are paired, so that copies send a row a task, not one a run
    and pair. Rare runs are all of a message less those found in too many. queries: rows of messages.
    """
    who = [F.col(key).alias("k"), *([] if thread == key else [F.col(thread).alias("t")])]
    of = "k" if thread == key else "t"
    hashed = F.transform(shingles(F.col(text)), lambda r: F.xxhash64(r, F.length(r)))
    found = cut(messages.select(*who, hashed.alias("runs")).filter(F.size("runs") > 0))  # made once, 8 bytes a run
    names = [c for c in found.columns if c != "runs"]
    runs = found.select(*names, F.explode("runs").alias("run"))
    # a run in too many of some messages is in too many of all: the most frequent go without a shuffle, the others are counted whole
    some = F.pmod(F.xxhash64("k"), F.lit(max(1, messages.count() // SOME))) == 0
    sure = F.broadcast(found.filter(some).limit(2 * SOME).select(F.explode("runs").alias("run")).groupBy("run").count().filter(F.col("count") > boilerplate).select("run"))
    counted = runs.join(sure, "run", "left_anti").withColumn("n", F.count(F.lit(1)).over(W.partitionBy("run"))).filter("n > 1 and k is not null")
    alone = F.when(F.col("n") > boilerplate, F.col("k"))
    groups = counted.groupBy("run", alone.alias("alone")).agg(F.sort_array(F.collect_list(F.struct(*names))).alias("of"))
    groups = cut(groups.groupBy("of", F.col("alone").isNotNull().alias("frequent")).agg(F.count(F.lit(1)).alias("n")))
    less = groups.filter("frequent").select(F.explode("of.k").alias("k"), (-F.col("n")).alias("n"))
    less = less.unionByName(runs.join(sure, "run", "left_semi").groupBy("k").agg((-F.count(F.lit(1))).alias("n")))
    n_rare = found.select("k", F.size("runs").cast("bigint").alias("n")).unionByName(less).groupBy("k").agg(F.sum("n").alias("n_rare"))
    firsts = groups.filter("not frequent").select(F.posexplode("of").alias("i", "a"), "of", "n")
    pairs = firsts.select("a", F.explode(F.slice("of", F.col("i") + 2, F.size("of"))).alias("b"), "n").filter(F.col(f"a.{of}") != F.col(f"b.{of}"))
    shared = pairs.groupBy(F.col("a.k").alias("a"), F.col("b.k").alias("b")).agg(F.sum("n").alias("n_shared"))
    both = shared.select(F.explode(F.array(F.struct(F.col("a").alias("k"), F.col("b").alias("twin")), F.struct(F.col("b").alias("k"), F.col("a").alias("twin")))).alias("x"), "n_shared").select("x.*", "n_shared")
    asked = both.join(queries.select(F.col(key).alias("k")).distinct(), "k", "left_semi")
    best = asked.groupBy("k").agg(F.min(F.struct((-F.col("n_shared")).alias("n"), "twin")).alias("best"))
    out = best.join(n_rare, "k").select(F.col("k").alias(key), "best.twin", (-F.col("best.n")).alias("n_shared"), "n_rare")
    return out.filter(F.col("n_shared") >= share * F.col("n_rare"))
