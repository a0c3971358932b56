"""The exchange of packets over several levels, and anchors of very many stretches, against the plain versions."""

import random
from collections import Counter

import numpy as np
import pytest
from test_llm_operators import WORD, brute_cover, docs, empty, texts  # noqa: F401

from askmine.llm import blocks, substring_dedup, suffix_dedup


@pytest.mark.parametrize(("fan_bits", "most_packets", "hot"), [(2, 2, 2), (8, 1024, 1), (3, 5, 10_000)])
def test_suffix_dedup_by_levels(docs, fan_bits, most_packets, hot):  # noqa: F811
    values = [(t or "").encode() for _, t in texts()]
    expected = Counter((i, sum(gone), bytes(c for c, g in zip(v, gone) if not g)) for (i, _), v, gone in zip(texts(), values, brute_cover(values, 200)))
    done = suffix_dedup.remove_repeats(docs, block_bytes=2000, fan_bits=fan_bits, most_packets=most_packets, hot=hot).collect()
    assert Counter((r["doc_id"], r["n_removed"], bytes(r["kept"])) for r in done) == expected


def test_a_gram_in_many_surroundings(spark):
    """One passage of 220 bytes in 300 surroundings: stretches that differ, of the same anchors."""
    rng = random.Random(4)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 7)))
    prose = lambda n: " ".join(word() for _ in range(n))
    passage, other = prose(60)[:220], prose(70)[:260]
    rows = [(i, f"{prose(rng.randint(1, 30))} {passage[rng.randint(0, 12) :]} {prose(rng.randint(0, 30))}{other[: rng.randint(150, 260)] if i % 3 == 0 else ''}") for i in range(300)]
    values = [t.encode() for _, t in rows]
    expected = {i: bytes(c for c, g in zip(v, gone) if not g) for (i, _), v, gone in zip(rows, values, brute_cover(values, 200))}
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    for hot in (5, 100_000):
        done = suffix_dedup.remove_repeats(df, block_bytes=9000, hot=hot).collect()
        assert {r["doc_id"]: bytes(r["kept"]) for r in done} == expected


@pytest.mark.parametrize(("fan_bits", "most_packets"), [(2, 2), (3, 5)])
def test_substring_dedup_by_levels(docs, fan_bits, most_packets):  # noqa: F811
    one = substring_dedup.remove_repeated_windows(docs).collect()
    many = substring_dedup.remove_repeated_windows(docs, block_bytes=2000, fan_bits=fan_bits, most_packets=most_packets).collect()
    assert Counter(many) == Counter(one) and sum(r["n_removed"] for r in one) > 100


def test_packets_grow_with_the_blocks():
    """A block sends at most a packet to each bucket of a level, however many blocks there are."""
    hashes = np.sort(np.random.default_rng(1).integers(0, 1 << 64, 50_000, np.uint64))
    assert blocks.packets(7, [hashes, hashes]).num_rows == 256
    assert [b for b, _, _ in blocks.parts_of(hashes, 1, 2)] == [0, 1, 2, 3]
