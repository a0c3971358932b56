"""Sharding along a Hilbert curve, in DataFrame operations only.

Several metadata dimensions are quantised to BITS bits each, the cell's place on a Hilbert curve is read off a state
table level by level, and the documents, in the order of the curve, are cut into runs of near-equal bytes. Files then
cover compact boxes of the metadata space, so that filters on any of the dimensions skip most of them.

Equal texts form a group, placed by the metadata of its smallest key, and lie next to each other. A group of up to
1/WHOLE of a shard's bytes goes to one shard as a whole, by its middle; a larger one (there are n_shards * WHOLE of them
at most, so that their table may be broadcast) is cut row by row, its rows ranked within SALTS parts. Running sums are
taken within buckets (cell and hash prefix), over the buckets of a cell, and over the cells, whose number is fixed.

A null text counts as empty and has size 1; null metadata are a value of their own. Repeated rows keep a slot each. An
empty table gives no rows. Only the named columns are read.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from askmine.llm.base import checkpointed

BITS, SALTS, SALTED, WHOLE = 5, 64, 1_000_000, 10


def curve_tables(dims: int) -> tuple[list[int], list[int]]:
    """(curve digit, next state), both by state * 2^dims + the level's bits, for a Hilbert curve in dims dimensions.

    A state is an entry corner and an axis; Gray codes give the corners' order within it.
    """
    corners = 1 << dims

    def turn(x: int, by: int) -> int:  # rotate dims bits to the left
        by %= dims
        return (x << by | x >> dims - by) & corners - 1

    def trailing_ones(i: int) -> int:
        return (~i & i + 1).bit_length() - 1

    def entry(w: int) -> int:
        return 0 if w == 0 else (e := 2 * ((w - 1) // 2)) ^ e >> 1

    def axis(w: int) -> int:
        return 0 if w == 0 else (trailing_ones(w - 1) if w % 2 == 0 else trailing_ones(w)) % dims

    states: dict[tuple[int, int], int] = {(0, 0): 0}
    digits, following = [], []
    for corner, direction in (todo := [(0, 0)]):
        for bits in range(corners):
            gray = turn(bits ^ corner, -(direction + 1))
            w = reduce(lambda x, s: x ^ x >> s, (1, 2, 4), gray)
            then = corner ^ turn(entry(w), direction + 1), (direction + axis(w) + 1) % dims
            if then not in states:
                states[then] = len(states)
                todo.append(then)
            digits.append(w)
            following.append(states[then])
    return digits, following


def curve_index(columns: list[Column], bits: int = BITS) -> Column:
    """The place on the curve (bigint) of integer columns of ``bits`` bits each."""
    dims = len(columns)
    digits, following = (F.array(*map(F.lit, t)) for t in curve_tables(dims))
    step = F.lit(1 << dims)

    def level(seen: Column, shift: Column) -> Column:
        corner = reduce(lambda a, b: a + b, [F.call_function("shiftright", c, shift).bitwiseAND(F.lit(1)) * (1 << i) for i, c in enumerate(columns)])
        at = seen["state"] * step + corner
        return F.struct(F.get(following, at).alias("state"), (seen["place"] * step + F.get(digits, at)).alias("place"))

    start = F.struct(F.lit(0).alias("state"), F.lit(0).cast("bigint").alias("place"))
    return F.aggregate(F.array(*[F.lit(b) for b in range(bits - 1, -1, -1)]), start, level, lambda seen: seen["place"])


def quantised_size(size: Column) -> Column:
    """Three classes per factor of four in size, 0 to 31."""
    return F.least(F.floor(F.log2(size.cast("double")) * 1.5), F.lit(31)).cast("int")


def quantised_name(name: Column) -> Column:
    """One of 32 classes of a name, for filters by equality."""
    return F.pmod(F.xxhash64(name), F.lit(1 << BITS)).cast("int")


def _running(df: DataFrame, window: W, **sums: str) -> DataFrame:
    """Sums over the rows before each one."""
    before = window.rowsBetween(W.unboundedPreceding, -1)
    return df.withColumns({k: F.coalesce(F.sum(v).over(before), F.lit(0)) for k, v in sums.items()})


def shards(docs: DataFrame, n_shards: int = 16, key: str = "doc_id", text: str = "text", names: tuple[str, ...] = ("source", "lang")) -> DataFrame:
    """key, size, text_crc32, place (on the curve), shard, slot (gapless from 0 within the shard, in the curve's order)."""
    body = F.coalesce(F.col(text).cast("string"), F.lit(""))
    rows = checkpointed(
        docs.select(
            F.col(key).alias("key"),
            (F.octet_length(body) + F.lit(1)).cast("bigint").alias("size"),
            F.crc32(body.cast("binary")).alias("crc"),
            F.xxhash64(body).alias("hash"),
            *[F.col(name).cast("string").alias(f"name{i}") for i, name in enumerate(names)],
        )
    )
    group = ["hash", "crc", "size"]
    n_rows, total = rows.agg(F.count(F.lit(1)), F.sum("size")).first()
    total, salts = total or 1, max(SALTS, n_rows // SALTED)  # parts grow in number, not in size
    head = F.min(F.struct("key", *[f"name{i}" for i in range(len(names))]))
    groups = rows.groupBy(*group).agg(head.alias("head"), F.count(F.lit(1)).alias("n"))
    dims = [quantised_size(F.col("size")), *[quantised_name(F.col(f"head.name{i}")) for i in range(len(names))]]
    groups = groups.select(*group, "n", (F.col("n") * F.col("size")).alias("bytes"), *[d.alias(f"dim{i}") for i, d in enumerate(dims)])
    placed = groups.select(*group, "n", "bytes", curve_index([F.col(f"dim{i}") for i in range(len(dims))]).alias("place"), F.pmod("hash", F.lit(salts)).cast("int").alias("part"))
    placed = checkpointed(placed)

    parts = placed.groupBy("place", "part").agg(F.sum("n").alias("part_n"), F.sum("bytes").alias("part_bytes"))
    in_cell = _running(parts, W.partitionBy("place").orderBy("part"), n0="part_n", bytes0="part_bytes")
    cells = parts.groupBy("place").agg(F.sum("part_n").alias("cell_n"), F.sum("part_bytes").alias("cell_bytes"))
    cells = _running(cells, W.orderBy("place"), n1="cell_n", bytes1="cell_bytes").select("place", "n1", "bytes1")  # 2^(BITS * dims) rows at most
    before = in_cell.join(F.broadcast(cells), "place").select("place", "part", (F.col("n0") + F.col("n1")).alias("n0"), (F.col("bytes0") + F.col("bytes1")).alias("bytes0"))
    in_part = _running(placed, W.partitionBy("place", "part").orderBy(*group), n2="n", bytes2="bytes")
    at = in_part.join(before, ["place", "part"]).select(*group, "n", "bytes", "place", (F.col("n0") + F.col("n2")).alias("first_row"), (F.col("bytes0") + F.col("bytes2")).alias("first_byte"))

    is_large = F.col("bytes") * (n_shards * WHOLE) > F.lit(total)
    large = F.broadcast(at.filter(is_large))  # n_shards * WHOLE rows at most, by the filter
    slim = rows.select("key", *group)
    whole = slim.join(large.select(*group), group, "left_anti").join(at.filter(~is_large), group)
    rank = W.partitionBy(*group, "salt").orderBy("key")
    whole = whole.withColumn("salt", F.lit(0)).withColumn("rank", (F.row_number().over(rank) - 1).cast("bigint")).withColumn("middle", F.col("first_byte") + F.col("bytes") / 2)
    cut = slim.join(large, group).withColumn("salt", F.pmod(F.xxhash64("key"), F.lit(salts)).cast("int"))
    salted = cut.groupBy(*group, "salt").count()
    salted = _running(salted, W.partitionBy(*group).orderBy("salt"), rank0="count").drop("count")  # a row a part of a large group
    cut = cut.join(salted, [*group, "salt"])
    cut = cut.withColumn("rank", F.col("rank0") + F.row_number().over(rank) - 1).withColumn("middle", F.col("first_byte") + (F.col("rank") + 0.5) * F.col("size")).drop("rank0")
    dealt = whole.unionByName(cut).select("key", "size", "crc", "place", (F.col("first_row") + F.col("rank")).alias("row"), F.least(F.floor(F.col("middle") * n_shards / F.lit(total)), F.lit(n_shards - 1)).cast("int").alias("shard"))
    dealt = checkpointed(dealt)
    first = dealt.groupBy("shard").agg(F.min("row").alias("first"))  # n_shards rows
    return dealt.join(F.broadcast(first), "shard").select(F.col("key").alias(key), "size", F.col("crc").alias("text_crc32"), "place", "shard", (F.col("row") - F.col("first")).alias("slot"))
