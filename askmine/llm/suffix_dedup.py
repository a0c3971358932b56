"""Suffix-array dedup of repeated byte strings.

All windows of ``length`` bytes can't be sorted as suffixes in one place, so they are dealt by content: the smallest
hashed 32-byte gram of a window (its anchor) is the same wherever the window's bytes occur. Neighbouring windows with
one anchor form a stretch, of which only (anchor hash, stretch hash) is sent, once per block (see ``blocks``). A bucket of
anchor hashes says of each stretch whether it also occurs elsewhere (then all its windows are repeated) and whether its
anchor occurs in other stretches. Only those send their bytes, once each, to be sorted: the suffixes that start at the
anchors, and the reversed prefixes that end there, by deep-shallow sorting. An anchor of over HOT_ANCHOR stretches deals
its windows into HOT_RANGES ranges by their bytes before it; for each range those stretches meet that share all bytes that
every window of the range has, so that a common gram in very many surroundings is not one task's. Multikey quicksort orders them to a shallow depth; each group that
still shares its prefix goes through a blind trie, which compares branching bytes on the way down and one longest
common prefix per string. A window with o bytes before its anchor is repeated exactly if another string lies in the
same longest-common-prefix interval at depth length - o of the suffixes and at depth o of the reversed prefixes.

Matches never cross documents. Overlapping strings count, in the same document too, and all are judged on the input.
Null and empty texts, and texts shorter than ``length``, keep all their bytes. Repeated rows are documents of their own,
so that long equal rows all lose all. An empty table gives no rows. Only the key (an integer) and the text are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql.types import LongType, StructField

from askmine.llm.base import release, text_buffer, with_fields
from askmine.llm.blocks import FAN_BITS, MOST_PACKETS, Block, Merge, answered, binaries, bits_of, blocked, mixed, packets, parts_of, released

GRAM = 32
GRAM_BASE = 0xA24BAED4963EE407
#: Bytes hashed at a time, and the low bits of a packed hash that hold a place among them.
STRIDE, PLACE_BITS = 1 << 18, 24
#: Stretches of an anchor above which they are dealt anew, into how many ranges, and bytes sorted at a time.
HOT_ANCHOR, HOT_RANGES, SORT_BYTES = 4_096, 8, 2 << 20
#: Bytes that multikey quicksort goes through before blind tries take over: a multiple of 8.
SHALLOW = 48


def _gram_hashes(data: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each run of GRAM bytes, by doubling."""
    h, base, width = data.astype(np.uint64) + np.uint64(1), GRAM_BASE, 1
    while width < GRAM:
        h = h[:-width] * np.uint64(base) + h[width:]
        base, width = base * base % (1 << 64), 2 * width
    return mixed(h)


def _sliding_least(v: np.ndarray, width: int) -> np.ndarray:
    reach, m = 1, v
    while 2 * reach <= width:
        m = np.minimum(m[:-reach], m[reach:])
        reach *= 2
    return m if reach == width else np.minimum(m[: len(v) - width + 1], m[width - reach : width - reach + len(v) - width + 1])


class Stretches:
    """A block's stretches: rows of (first window, last window, anchor), and their distinct (anchor, stretch) hashes."""

    def __init__(self, rows: pa.Table, length: int):
        self.block = block = Block(rows, b"")
        self.length = length
        data, n = block.bytes, len(block.bytes)
        long_ = block.lengths >= length
        firsts, lasts = block.starts[long_], block.ends[long_] - length  # windows of a text: first and last start
        found = [(np.zeros(0, np.int64),) * 3 + (np.zeros(0, np.uint64),)]
        low = np.uint64((1 << PLACE_BITS) - 1)
        for a in range(0, max(0, n - length + 1), STRIDE):
            b = min(a + STRIDE, n - length + 1)
            h = _gram_hashes(data[a : b + length - 1])
            v = (h & ~low) | (low - np.arange(len(h), dtype=np.uint64))
            place = (low - (_sliding_least(v, length - GRAM + 1) & low)).astype(np.int64)
            step = np.zeros(b - a + 1, np.int8)
            i, j = np.searchsorted(lasts, a), np.searchsorted(firsts, b)
            x, y = np.maximum(firsts[i:j], a) - a, np.minimum(lasts[i:j] + 1, b) - a
            step[x] += 1
            step[y] -= 1
            valid = np.cumsum(step[:-1], dtype=np.int8).astype(bool)
            edge = np.ones(b - a, bool)
            edge[1:] = place[1:] != place[:-1]
            edge[x] = True
            starts = np.flatnonzero(edge & valid)
            stop = np.flatnonzero(np.append((edge | ~valid)[1:], True) & valid)
            found.append((starts + a, stop + a, place[starts] + a, h[place[starts]]))
        self.first, self.last, self.anchor, gram = (np.concatenate(x) for x in zip(*found))
        gram = mixed(gram)  # anchors have the smallest hashes: mixed again (one to one), they fill all buckets evenly
        view, digest = memoryview(data), xxhash.xxh3_64_intdigest
        whole = np.fromiter((digest(view[a:b], c) for a, b, c in zip(self.first.tolist(), (self.last + length).tolist(), (self.anchor - self.first).tolist())), np.uint64, len(gram))
        order = np.lexsort((whole, gram))
        gram, whole = gram[order], whole[order]
        new = np.ones(len(gram), bool)
        new[1:] = (gram[1:] != gram[:-1]) | (whole[1:] != whole[:-1])
        self.gram, self.whole, self.one = gram[new], whole[new], order[new]
        self.of = np.empty(len(gram), np.int64)
        self.of[order] = np.cumsum(new) - 1
        self.twice = np.bincount(self.of, minlength=len(self.gram)) > 1


class Stretched(Merge):
    """Of entries (anchor hash, stretch hash): the stretch occurs elsewhere too; its anchor occurs in other stretches, and in
    over ``hot`` of them; and this entry is to send the stretch's bytes, of all entries that have it."""

    kinds = 4

    def __init__(self, hot: int):
        self.hot = hot

    def __call__(self, grams: np.ndarray, wholes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        order = np.lexsort((np.arange(len(grams)), wholes, grams))
        g, w = grams[order], wholes[order]
        new_gram = np.concatenate([[True], g[1:] != g[:-1]])[: len(g)]
        new = new_gram | np.concatenate([[True], w[1:] != w[:-1]])[: len(g)]
        of, of_gram = np.cumsum(new) - 1, np.cumsum(new_gram) - 1
        many = np.bincount(of_gram, weights=new)[of_gram] if len(g) else np.zeros(0)
        bits = np.zeros((4, len(g)), bool)
        bits[:, order] = [(np.bincount(of) > 1)[of] if len(g) else new, many > 1, many > self.hot, new]
        back = np.empty(len(g), np.int64)
        back[order] = of
        return order[new], back, bits

    def combined(self, own: np.ndarray, above: np.ndarray) -> np.ndarray:
        return np.concatenate([own[:3] | above[:3], own[3:] & above[3:]])


def ranges_of(length: int, is_hot: bool) -> list[tuple[int, int]]:
    """The numbers of bytes before the anchor that windows have, in one range, or in several for an anchor of very many stretches."""
    reach = length - GRAM + 1
    step = -(-reach // HOT_RANGES) if is_hot else reach
    return [(o, min(o + step, reach)) for o in range(0, reach, step)]


def _send(length: int, fan_bits: int):
    """Rows (deal, block, at, whole, left, right, covered, low, high, bytes) of stretches whose anchor other stretches have.

    deal says which rows may share a window with low to high - 1 bytes before the anchor: all of one anchor; or, of an anchor
    of very many stretches, those that share all bytes that any of these windows has.
    """

    def run(key: tuple, rows: pa.Table, answers: pa.Table) -> pa.Table:
        s = Stretches(rows, length)
        elsewhere, mixed_, hot, sends = bits_of(answers, parts_of(s.gram, 1, fan_bits), Stretched.kinds)
        covered = s.twice | elsewhere
        at = np.flatnonzero(mixed_ & (sends | ~covered))
        one = s.one[at]
        view, digest = memoryview(s.block.bytes), xxhash.xxh3_64_intdigest
        out: list[tuple] = []
        for i, a, b, p, g, is_hot in zip(at.tolist(), s.first[one].tolist(), (s.last[one] + length).tolist(), s.anchor[one].tolist(), s.gram[at].tolist(), hot[at].tolist()):
            if not is_hot:
                out.append((g, i, p - a, b - p, 0, length - GRAM + 1, a, b))
                continue
            for low, high in ranges_of(length, True):
                x, y = p - low, p + length - high + 1
                if x >= a and y <= b:
                    out.append((digest(view[x:y], g & (1 << 63) - 1 ^ low), i, p - a, b - p, low, high, a, b))
        deal, i, left, right, low, high, a, b = (np.array(x, dtype=t) for x, t in zip(zip(*out), (np.uint64, *[np.int64] * 7))) if out else (np.zeros(0, np.uint64), *[np.zeros(0, np.int64)] * 7)
        small = lambda x: pa.array(x, pa.int32())
        return pa.table(
            {
                "deal": pa.array(deal.view(np.int64)), "block": small([key[0].as_py()] * len(i)), "at": small(i), "whole": pa.array(s.whole[i].view(np.int64)),
                "left": small(left), "right": small(right), "covered": pa.array(covered[i]), "low": small(low), "high": small(high), "bytes": binaries([view[x:y].tobytes() for x, y in zip(a.tolist(), b.tolist())]),
            }
        )

    return released(run)


class BlindTrie:
    """Strings that share a long prefix: inner nodes keep only where they branch and on which byte."""

    __slots__ = ("root", "size")

    def __init__(self, size: int):
        self.root, self.size = None, size

    def insert(self, name: int, value: int) -> None:
        """value: the string's bytes as one big-endian number of ``size`` bytes."""
        if self.root is None:
            self.root = [self.size, None, [name], value]
            return
        path, node = [], self.root
        while node[1] is not None:  # blind: only the branching bytes are looked at
            path.append(node)
            node = node[1].get(value >> 8 * (self.size - 1 - node[0]) & 255) or next(iter(node[1].values()))
        other = node[3]
        common = self.size - ((value ^ other).bit_length() + 7 >> 3)
        if common == self.size:
            node[2].append(name)
            return
        leaf = [self.size, None, [name], value]
        byte = value >> 8 * (self.size - 1 - common) & 255
        above = None
        for step in [*path, node]:
            if step[0] >= common:
                if step[0] == common and step[1] is not None:
                    step[1][byte] = leaf
                    return
                break
            above = step
        branch = [common, {byte: leaf, other >> 8 * (self.size - 1 - common) & 255: step}, None, None]
        if above is None:
            self.root = branch
        else:
            above[1][value >> 8 * (self.size - 1 - above[0]) & 255] = branch

    def ordered(self) -> tuple[list[int], list[int]]:
        """The names in order, and the common prefix of each with the one before it (of the first: 0)."""
        names, common = [], []
        todo = [(self.root, 0)] if self.root is not None else []
        while todo:
            node, shared = todo.pop()
            if node[1] is None:
                names += node[2]
                common += [shared, *[self.size] * (len(node[2]) - 1)]
            else:
                kids = [node[1][k] for k in sorted(node[1])]
                todo += [(kid, node[0]) for kid in kids[:0:-1]]
                todo.append((kids[0], shared))
        return names, common


def deep_shallow(rows: np.ndarray, shallow: int = SHALLOW) -> tuple[np.ndarray, np.ndarray]:
    """Order of equally long byte strings (n, size), and the common prefix of each with its predecessor in that order."""
    n, size = rows.shape
    words = np.ascontiguousarray(rows).view(">u8").astype(np.uint64).reshape(n, size // 8)
    order, group = np.arange(n), np.zeros(n, np.int64)
    common = np.zeros(n, np.int64)
    tied = np.ones(n, bool)  # in a group of several
    for k in range(min(shallow, size) // 8):  # multikey quicksort: the open groups are parted by their next 8 bytes
        at = np.flatnonzero(tied)
        if not len(at):
            break
        inner = np.lexsort((words[order[at], k], group[at]))
        order[at] = order[at[inner]]
        word = words[order[at], k]
        g = group[at]
        parted = np.flatnonzero((g[1:] == g[:-1]) & (word[1:] != word[:-1])) + 1
        if len(parted):
            common[at[parted]] = 8 * k + _common_bytes(word[parted - 1], word[parted])
        new = np.zeros(n, bool)
        new[0] = True
        new[1:] = group[1:] != group[:-1]
        new[at[parted]] = True
        group = np.cumsum(new) - 1
        sizes = np.bincount(group)
        tied = sizes[group] > 1
    at = np.flatnonzero(tied)
    if len(at):
        depth = min(shallow, size) // 8 * 8
        tail = rows[:, depth:]
        edges = np.flatnonzero(np.concatenate([[True], group[at][1:] != group[at][:-1]]))
        for i, j in zip(edges.tolist(), [*edges[1:].tolist(), len(at)]):
            span = slice(at[i], at[j - 1] + 1)
            members = order[span]
            trie = BlindTrie(size - depth)
            for name, value in zip(members.tolist(), tail[members]):
                trie.insert(name, int.from_bytes(value.tobytes(), "big"))
            names, shared = trie.ordered()
            order[span] = names
            common[span.start + 1 : span.stop] = np.array(shared[1:]) + depth
    return order, common


def _common_bytes(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Leading bytes that differing big-endian words share."""
    x = a ^ b
    out = np.zeros(len(x), np.int64)
    for k in range(1, 8):
        out += x >> np.uint64(8 * (8 - k)) == 0
    return out


def repeated_windows(left: np.ndarray, right: np.ndarray, before: np.ndarray, after: np.ndarray, length: int, low: int = 0, high: int | None = None) -> np.ndarray:
    """(string, o): whether the window with o bytes before the anchor, low to high - 1, also lies in another of the strings.

    left: the reversed bytes before the anchors (before has their numbers); right: the bytes from the anchors on
    (after has their numbers); both padded with zeros. The strings must differ.
    """
    n, reach = len(left), length - GRAM + 1
    (r_order, r_common), (l_order, l_common) = deep_shallow(right), deep_shallow(left)
    r_rank, l_rank = np.empty(n, np.int64), np.empty(n, np.int64)
    r_rank[r_order], l_rank[l_order] = np.arange(n), np.arange(n)
    out = np.zeros((n, reach), bool)
    for o in range(low, reach if high is None else high):
        at = np.flatnonzero((before >= o) & (after >= length - o))
        if len(at) < 2:
            continue
        right_class = np.cumsum(r_common < length - o)[r_rank[at]]
        left_class = np.cumsum(l_common < o)[l_rank[at]] if o else 0
        pair = right_class * (n + 1) + left_class
        order = np.argsort(pair)
        pair = pair[order]
        same = pair[1:] == pair[:-1]
        twice = np.zeros(len(at), bool)
        twice[1:] |= same
        twice[:-1] |= same
        out[at[order[twice]], o] = True
    return out


def _sorted_rows(rows: pa.Table, length: int) -> pa.RecordBatch:
    """block, at, windows (a bit for each number of bytes before the anchor) of the rows that aren't covered and share a window."""
    before, after, low, high = (rows[c].to_numpy().astype(np.int64) for c in ("left", "right", "low", "high"))
    whole, covered, deal = rows["whole"].to_numpy(), rows["covered"].to_numpy(zero_copy_only=False), rows["deal"].to_numpy()
    data, ends = text_buffer(rows["bytes"])
    anchor = ends[:-1] + before
    gram = data[anchor[:, None] + np.arange(GRAM)].view(f"V{GRAM}").ravel()
    _, gram = np.unique(gram, return_inverse=True)
    found = np.zeros((len(whole), length - GRAM + 1), bool)
    for x, y in sorted({*zip(low.tolist(), high.tolist())}):  # one range, but for anchors of very many stretches
        at = np.flatnonzero((low == x) & (high == y))
        order = at[np.lexsort((whole[at], gram[at], deal[at]))]
        new = np.concatenate([[True], (gram[order][1:] != gram[order][:-1]) | (whole[order][1:] != whole[order][:-1]) | (deal[order][1:] != deal[order][:-1])])
        of = np.empty(len(whole), np.int64)
        of[order] = np.cumsum(new) - 1
        one = order[new]
        width = -(-length // 8) * 8
        span = np.arange(width, dtype=np.int32)
        left = np.where(span < before[one, None], data[np.maximum(anchor[one, None] - 1 - span, 0)], 0).astype(np.uint8)
        right = np.where(span < after[one, None], data[np.minimum(anchor[one, None] + span, len(data) - 1)], 0).astype(np.uint8)
        found[at] = repeated_windows(left, right, before[one], after[one], length, x, y)[of[at]]
    found &= ~covered[:, None]
    some = np.flatnonzero(found.any(1))
    bits = np.packbits(found[some], axis=1)
    return pa.RecordBatch.from_arrays([pa.array(rows["block"].to_numpy()[some]), pa.array(rows["at"].to_numpy()[some]), binaries([x.tobytes() for x in bits])], ["block", "at", "windows"])


def _sort(length: int):
    """Whole deals at a time, as many as SORT_BYTES hold; rows come by deal."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        size = 0
        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(batch)
            size += batch.nbytes
            if size < SORT_BYTES or batch["deal"][-1] == held[0]["deal"][0]:
                continue
            rows = pa.Table.from_batches(held).combine_chunks()
            cut = int(np.searchsorted(rows["deal"].to_numpy(), rows["deal"][-1].as_py()))
            yield _sorted_rows(rows.slice(0, cut), length)
            held = pa.concat_tables([rows.slice(cut)]).to_batches()
            size = sum(x.nbytes for x in held)
            release()
        if held:
            yield _sorted_rows(pa.Table.from_batches(held).combine_chunks(), length)
        release()

    return run


def _whole_characters(removed: np.ndarray, data: np.ndarray) -> np.ndarray:
    """Only characters all of whose bytes are removed."""
    first = np.flatnonzero((data & 0xC0) != 0x80)
    if not len(first):
        return removed
    return np.repeat(np.logical_and.reduceat(removed, first), np.diff(np.append(first, len(data))))


def _apply(length: int, fan_bits: int, whole_characters: bool):
    def run(key: tuple, rows: pa.Table, answers: pa.Table) -> pa.Table:
        s = Stretches(rows, length)
        block = s.block
        is_sorted = answers["windows"].is_valid()
        elsewhere = bits_of(answers.filter(pc.invert(is_sorted)), parts_of(s.gram, 1, fan_bits), Stretched.kinds)[0]
        step = np.zeros(len(block.bytes) + 1, np.int32)
        whole = (s.twice | elsewhere)[s.of]
        np.add.at(step, s.first[whole], 1)
        np.subtract.at(step, s.last[whole] + length, 1)
        reach = length - GRAM + 1
        windows = answers.filter(is_sorted)
        if len(windows):
            bits = np.zeros((len(s.gram), -(-reach // 8)), np.uint8)
            np.bitwise_or.at(bits, windows["at"].to_numpy(), np.frombuffer(b"".join(windows["windows"].to_pylist()), np.uint8).reshape(len(windows), -1))
            some = np.flatnonzero(~whole & bits.any(1)[s.of])
            for at in np.array_split(some, len(some) // 4_000 + 1):
                i, o = np.nonzero(np.unpackbits(bits[s.of[at]], axis=1, count=reach))
                w = s.anchor[at[i]] - o
                np.add.at(step, w, 1)
                np.subtract.at(step, w + length, 1)
        removed = np.cumsum(step[:-1]) > 0
        if whole_characters:
            removed = _whole_characters(removed, block.bytes)
        opens = removed.copy()
        opens[1:] &= ~removed[:-1]
        inside = block.starts[block.lengths > 0]
        opens[inside] = removed[inside]
        count, spans = (np.concatenate([[0], np.cumsum(x)]) for x in (removed, opens))
        data = block.bytes[~removed]
        kept = np.arange(len(removed) + 1) - count
        runs_open = np.flatnonzero(opens)
        closes = removed.copy()
        closes[:-1] &= ~removed[1:]
        closes[block.ends[block.lengths > 0] - 1] = removed[block.ends[block.lengths > 0] - 1]
        runs_close = np.flatnonzero(closes) + 1
        lists_at = spans[block.starts], spans[block.ends]
        pairs = [np.stack([runs_open[a:b] - x, runs_close[a:b] - x], 1).ravel() for a, b, x in zip(*lists_at, block.starts)]
        return pa.table(
            {
                "key": block.key_array(),
                **({} if block.row is None else {"row": block.row}),
                "n_bytes": pa.array(block.lengths, pa.int64()),
                "n_removed": pa.array(count[block.ends] - count[block.starts], pa.int64()),
                "spans": pa.array(pairs, pa.list_(pa.int64())),
                "kept": binaries([None if gone else data[a:b].tobytes() for a, b, gone in zip(kept[block.starts], kept[block.ends], block.null_text & whole_characters)]),
            }
        )

    return released(run)


def remove_repeats(
    docs: DataFrame, key: str = "doc_id", text: str = "text", length: int = 200, block_bytes: int = 4 << 20, whole_characters: bool = False, carry: bool = False,
    fan_bits: int = FAN_BITS, most_packets: int = MOST_PACKETS, hot: int = HOT_ANCHOR,
) -> DataFrame:
    """key, n_bytes, n_removed, spans (starts and ends of the maximal removed runs, in turn), kept (the other bytes).

    whole_characters: a character of which only some bytes are covered stays, so that kept is UTF-8 (and null for a null
    text). carry: a struct ``row`` of the row's other columns comes along.
    """
    if length < 2 * GRAM:
        raise ValueError(f"strings of {2 * GRAM} bytes at least")
    blocks, n = blocked(docs, key, text, block_bytes, carry)
    row = [blocks.schema["row"]] if carry else []

    def ask(key: tuple, rows: pa.Table) -> pa.Table:
        s = Stretches(rows, length)
        return packets(key[0].as_py(), [s.gram, s.whole], 1, fan_bits)

    asked = blocks.groupBy("block").applyInArrow(released(ask), "bucket int, block int, c0 binary, c1 binary")
    answers = answered(asked, 2, Stretched(hot), n, fan_bits, most_packets)
    sent = blocks.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(
        _send(length, fan_bits), "deal bigint, block int, at int, whole bigint, left int, right int, covered boolean, low int, high int, bytes binary"
    )
    windows = sent.repartition("deal").sortWithinPartitions("deal").mapInArrow(_sort(length), "block int, at int, windows binary")
    told = answers.unionByName(windows, allowMissingColumns=True)
    schema = with_fields([StructField("key", LongType()), *row], "n_bytes bigint, n_removed bigint, spans array<bigint>, kept binary")
    done = blocks.groupBy("block").cogroup(told.groupBy("block")).applyInArrow(_apply(length, fan_bits, whole_characters), schema)
    return done.withColumnRenamed("key", key)
