"""Counters of one pass, progress, shards of a skewed order, the parser of ambiguous words, models of assignments."""

import pytest
from pyspark.sql import functions as F

from askmine.functions import recognizers
from askmine.operators import progress, spans
from askmine.sources import mbox, shards
from tests.test_mailboxes import mail


def test_counters_of_an_extraction(spark, tmp_path):
    (tmp_path / "a.mbox").write_bytes(mail(1, "m1", "first text") + mail(2, "m1", "other words") + mail(3, "m2", "> only quoted"))
    spark.dataSource.register(mbox.MboxSource)
    rows, seen = progress.counted_by(mbox.extracted(spark.read.format("mbox").load(str(tmp_path))), "extraction", "drop_reason", ["dup_id", "dup_body", "empty_body"])
    rows.write.parquet(str(tmp_path / "out"))
    assert seen.get == {"rows": 3, "kept": 1, "dup_id": 1, "dup_body": 0, "empty_body": 1}
    nothing, none = progress.counted(spark.range(0), "nothing", odd=F.col("id") % 2 == 1)
    nothing.collect()
    assert none.get == {"rows": 0, "odd": 0}


def test_progress_tells_tasks(spark):
    told = []
    with progress.Progress(spark, "sum", told.append, every=0.05) as run:
        spark.range(0, 3_000_000, 1, 6).selectExpr("sum(id * id % 7)").collect()
    assert run.done == run.known >= 6 and told[-1].startswith("sum: ") and told[-1].endswith("done")
    spark.range(10).collect()
    assert run.look()[0] == run.known


def test_shards_of_a_skewed_order(spark):
    values = [*range(5000), 10**15, -(10**15)]
    df = spark.createDataFrame([(v,) for v in values], "offset long").repartition(4)
    numbered = shards.with_shard(df, "offset", 100, range_rows=500)
    got = {r["offset"]: r["shard"] for r in numbered.collect()}
    assert got == {v: f"emails-{i // 100:05d}" for i, v in enumerate(sorted(values))}


def test_ambiguous_words_by_a_parser(spark):
    known = recognizers.recognizers(ambiguous=["Do"])
    df = spark.createDataFrame([("m1", "", "Do Nguyen came"), ("m2", "", "Do come")], "id string, subject string, body string")

    def parser(text):
        name = "Nguyen" in text
        return [(0, 2, "PROPN" if name else "AUX", ""), (3, 9, "PROPN" if name else "VERB", "")]

    scores = lambda **how: {r["email_id"]: r["score"] for r in spans.flagged(df, known, **how).filter("recognizer = 'denylist_ambiguous'").collect()}
    assert scores(parser=parser) == {"m1": recognizers.PAIRED, "m2": recognizers.ORDINARY}
    assert len(set(scores().values())) == 1


def test_assignments_of_another_model_are_stale(spark):
    of = lambda model: spark.createDataFrame([("a", model)], "chunk_id string, model string")
    shards.refuse_stale(of("m"), of("m"))
    with pytest.raises(ValueError, match="cluster again"):
        shards.refuse_stale(of("m"), of("n"))
