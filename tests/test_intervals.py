"""Points inside intervals, against all pairs, with one group that holds most rows."""

import duckdb
import numpy as np
from pyspark.sql import functions as F

from askmine.operators import dedupe
from askmine.plans.queries import ORACLES, QUERIES


def test_contained_is_that_of_all_pairs(spark):
    rng = np.random.default_rng(9)
    group = lambda: "hot" if rng.random() < 0.8 else [None, "a", "b"][int(rng.integers(0, 3))]
    intervals = [(group(), int(a), int(a + rng.integers(0, 12))) for a in rng.integers(0, 3000, 600)] + [("hot", None, 5), ("a", 3, None)]
    points = [(i, group(), int(s), int(s + rng.integers(0, 6))) for i, s in enumerate(rng.integers(0, 3000, 900))] + [(1000, "hot", None, 4), (1001, "hot", 4, None), (1002, "c", 1, 2), (5, "hot", 10, 11), (5, "hot", 10, 11)]
    inside = lambda g, s, e: None not in (g, s, e) and any(h == g and None not in (a, b) and a <= s and e <= b for h, a, b in intervals)
    got = dedupe.contained(spark.createDataFrame(points, "id int, g string, s int, `e.x` int").repartition(5), spark.createDataFrame(intervals, "h string, low int, high int").withColumnRenamed("h", "g"), ["g"], "s", "`e.x`", "low", "high")
    want = sorted(p for p in points if inside(*p[1:]))
    assert got.columns == ["id", "g", "s", "e.x"] and sorted(map(tuple, got.collect())) == want and 100 < len(want) < 700
    none = spark.createDataFrame([], "g string, low int, high int")
    assert dedupe.contained(spark.createDataFrame(points, "id int, g string, s int, e int"), none, ["g"], "s", "e", "low", "high").count() == 0


def test_span_clusters_of_missing_days_and_parts_of_pieces(spark, tmp_path):
    lines = [(1, None, 5.0), (1, "1996-01-10", 2.5), (1, "1996-01-12", 3.5), (1, "1996-01-16", 1.7), (1, "1996-01-18", None), (1, "1996-01-20", 1.0), (1, None, None), (2, None, 4.0), (2, None, 4.0), (None, "1996-01-01", 0.5), (None, "1996-01-01", 0.5), (None, None, 1.0)]
    file = str(tmp_path / "lineitem.parquet")
    spark.createDataFrame(lines, "l_suppkey bigint, l_shipdate string, l_quantity double").withColumn("l_shipdate", F.col("l_shipdate").cast("timestamp_ntz")).coalesce(1).write.parquet(file)
    with duckdb.connect() as db:
        db.execute(f"CREATE VIEW lineitem AS SELECT * FROM '{file}/*.parquet'")
        want = db.execute(ORACLES["span_clusters"]).fetchall()
    got = QUERIES["span_clusters"](spark, str(tmp_path)).select("l_suppkey", "run_start", "run_end", "n").collect()
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str) and sum(r["n"] for r in got) == len(lines)
