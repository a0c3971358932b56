"""Density clusters: projection, HDBSCAN on distinct points (see ``hierarchy``), and a label for every row.

Equal points count once in the hierarchy, and as often as they occur in the sizes. Labels are 0 for the largest cluster on;
noise is -1. Vectors must be of one width.
"""

from __future__ import annotations

from pyspark.ml.feature import PCA
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from askmine.operators import hierarchy
from askmine.operators.dedupe import cut

MIN_SIZE, MIN_SAMPLES, DIMENSIONS, METHOD = 15, 5, 5, "eom"
SWEEP = [(method, size, samples) for method in ("eom", "leaf") for size in (10, 15, 25, 40) for samples in (None, 5)]


def projected(vectors: DataFrame, key: str, vector: str, dimensions: int = DIMENSIONS) -> DataFrame:
    """key, point: unit vectors on their principal axes (as many as there are, at most)."""
    norm = F.sqrt(F.aggregate(F.transform(vector, lambda x: x.cast("double") * x), F.lit(0.0), lambda a, b: a + b))
    unit = vectors.select(key, F.transform(vector, lambda x: F.when(norm > 0, x.cast("double") / norm).otherwise(0.0)).alias("_u"), norm.alias("_n"))
    least, width = unit.agg(F.min(F.size("_u")), F.max(F.size("_u"))).first()
    if least != width:
        raise ValueError(f"vectors of {least} to {width} numbers: they must be of one width")
    width = width or 0
    if width <= dimensions:
        return unit.select(key, F.col("_u").alias("point"))
    rows = unit.select(key, array_to_vector("_u").alias("_v"))
    model = PCA(k=dimensions, inputCol="_v", outputCol="_p").fit(rows)
    return model.transform(rows).select(key, vector_to_array("_p").alias("point"))


def mapped(vectors: DataFrame, key: str, vector: str) -> DataFrame:
    """key, x, y: a flat map of the vectors, on their two principal axes, within -1 to 1."""
    flat = projected(vectors, key, vector, 2)
    most = F.lit(flat.agg(F.max(F.greatest(F.abs(F.get("point", F.lit(0))), F.abs(F.get("point", F.lit(1)))))).first()[0] or 1.0)
    return flat.select(key, (F.get("point", F.lit(0)) / most).alias("x"), (F.get("point", F.lit(1)) / most).alias("y"))


def _distinct(vectors: DataFrame, key: str, vector: str, dimensions: int) -> tuple[DataFrame, DataFrame, int, int]:
    """(key, name of every row; id, point, copies of the distinct points; their number and width)."""
    points = projected(vectors, key, vector, dimensions)
    named = points.withColumn("name", F.xxhash64(F.transform("point", lambda x: F.round(x, 9) + 0.0)))
    distinct = cut(named.groupBy(F.col("name").alias("id")).agg(F.min("point").alias("point"), F.count(F.lit(1)).alias("copies")))
    n, width = distinct.agg(F.count(F.lit(1)), F.max(F.size("point"))).first()
    return named.select(key, "name"), distinct, n, width or 1


def clustered(vectors: DataFrame, key: str, vector: str, min_size: int = MIN_SIZE, min_samples: int | None = MIN_SAMPLES, method: str = METHOD, dimensions: int = DIMENSIONS) -> DataFrame:
    """key, cluster, probability (three decimals) of every row."""
    named, distinct, n, width = _distinct(vectors, key, vector, dimensions)
    k = max(1, min(min_samples or min_size, n))
    cored = hierarchy.with_cores(hierarchy.packed_leaves(distinct, n, width), width, k)
    found = cut(hierarchy.labelled(*hierarchy.merged(cut(hierarchy.edges(cored, width, k, k)), min_size), method))
    sizes = found.filter("raw >= 0").join(distinct.select("id", "copies"), "id").groupBy("raw").agg(F.sum("copies").alias("n"))  # a row a cluster
    rank = F.row_number().over(W.orderBy(F.col("n").desc(), "raw")) - 1
    ranked = F.broadcast(sizes.select("raw", rank.alias("cluster")))
    told = found.join(ranked, "raw", "left").select(F.col("id").alias("name"), "cluster", F.round("strength", 3).alias("probability"))
    return named.join(told, "name", "left").select(key, F.coalesce("cluster", F.lit(-1)).alias("cluster"), F.coalesce("probability", F.lit(0.0)).alias("probability"))


def sweep(vectors: DataFrame, key: str, vector: str, dimensions: int = DIMENSIONS, settings: list[tuple] = SWEEP) -> DataFrame:
    """method, size, samples, clusters, noise (%), largest (%) of every setting on one projection; shares are of all rows.

    Distances to nearest points are found once, edges once per number of samples, merges once per that and size.
    """
    _, distinct, n, width = _distinct(vectors, key, vector, dimensions)
    within = lambda k: max(1, min(k, n))
    most = within(max(samples or size for _, size, samples in settings))
    cored = hierarchy.with_cores(hierarchy.packed_leaves(distinct, n, width), width, most)
    copies, total = distinct.select("id", "copies"), distinct.agg(F.sum("copies")).first()[0] or 0
    edges: dict[int, DataFrame] = {}
    merged: dict[tuple[int, int], tuple[DataFrame, DataFrame]] = {}
    rows = None
    for method, size, samples in settings:
        k = within(samples or size)
        if k not in edges:
            edges[k] = cut(hierarchy.edges(cored, width, most, k))
        if (k, size) not in merged:
            merged[k, size] = hierarchy.merged(edges[k], size)
        sizes = hierarchy.labelled(*merged[k, size], method).filter("raw >= 0").join(copies, "id").groupBy("raw").agg(F.sum("copies").alias("n"))
        share = lambda x: F.lit(100.0) * F.coalesce(x, F.lit(0)) / F.lit(max(1, total))
        own = sizes.agg(F.count(F.lit(1)).cast("int").alias("clusters"), (F.lit(100.0) - share(F.sum("n"))).alias("noise"), share(F.max("n")).alias("largest"))
        own = own.select(F.lit(method).alias("method"), F.lit(size).alias("size"), F.lit(samples).cast("int").alias("samples"), "*")
        rows = own if rows is None else rows.unionByName(own)
    return rows
