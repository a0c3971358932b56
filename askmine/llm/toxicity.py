"""Toxicity: a support vector machine over a string-subsequence kernel with Nystroem landmarks.

The kernel of two words counts their common subsequences of ORDER letters, each weighed by DECAY to the letters that it
spans in both, and is normalised. Gaps cost little, so a word with inserted characters stays close to the word itself;
characters other than letters drop out before ("i.d-i*o_t"), digits count as the letters that they stand for, and a run
of three or more single letters counts as one word as well ("i d i o t"). Every letter of any script is itself. A landmark's kernel is taken for words that have at least SHARE of its
distinct letters (an insertion or a gap takes none away) and at most twice its length; elsewhere it is 0, in training and
scoring alike. A sentence has the largest kernel value of its words for each landmark, mapped by the landmarks' inverse
root kernel matrix (Nystroem); the machine scores sentences. A text has four facts: its highest sentence's score, the
sums of its sentences' scores above two margins, and its number of words (one weak hit in a long text is no evidence); a
logistic function of them is calibrated by isotonic regression over rows.

Training takes labelled sentences from at most about TRAIN_ROWS labelled rows or SAMPLE_BYTES of whole texts, chosen by a
hash of the key (documented bounds; all rows are scored). Landmarks are words of up to LONGEST letters, or beginnings that
STEM such words share, that the toxic rows hold unusually often, none too close to one before it, and their nearest words
in the others. A toxic row stands for its STAND highest-scoring sentences, chosen anew in each round; all sentences of the
others are negative. Copies of the toxic words with inserted letters join as positives.

Null, empty and blank texts have no words and get the score of a text without any landmark's word. Without labels of
both kinds every score is 0.5. Rows with a null label aren't learnt from, and of repeated labels each counts. Repeated
rows each get a score, equal ones the same. Texts are read whole, whatever their length. An empty table gives no rows.
Other columns, whatever their names, aren't read, or come along in the struct.
"""

from __future__ import annotations

import unicodedata
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from askmine.llm.base import checkpointed, quoted, release, row_blocks, row_of, text_buffer, with_fields
from askmine.llm.calibrate import calibrated, isotonic
from askmine.llm.substring_dedup import IS_SPACE, word_bounds, word_hashes

ORDER, DECAY, SHARE = 3, 0.6, 0.8
#: Rows to learn from, landmarks of toxic words and of near other words, rounds of choosing sentences, and the machine's cost.
TRAIN_ROWS, LANDMARKS, NEAR, ROUNDS, COST = 4000, 48, 24, 4, 2.0
#: Kernel value above which a word is too close to a landmark to be another, smallest eigenvalue, and sentences that stand for a row.
CLOSE, LEAST, STAND = 0.7, 0.05, 4
#: Words whose kernel values a worker remembers; then it begins anew.
CACHE = 50_000
#: Sentence scores from which a text's sentences add up.
MARGINS = (-1.0, -0.5)
#: Logarithm of the least ratio of frequencies of a landmark, its most letters, and how many of such words make their common beginning one.
ODDS, LONGEST, STEM = 2.1, 32, 3
SHARD_BYTES, TRAIN_BYTES, SAMPLE_BYTES, SEED = 1 << 20, 1 << 20, 24 << 20, 20240229
#: Digits that stand for letters.
DIGITS = dict(zip("013457", "oieast"))
ENDS = np.isin(np.arange(256), list(b".!?"))


def _letter(place: int) -> int:
    """The code of a character: 0 drops out, 1 to 26 are a to z, any other letter or mark has a code of its own, by its small form."""
    char = chr(place)
    char = DIGITS.get(char, char.lower())
    if char.isascii():
        return ord(char) - 96 if char.isalpha() else 0
    return ord(char[0]) if char[0].isalpha() or unicodedata.category(char[0]) in ("Mc", "Mn") and ord(char[0]) >= 0x370 else 0


#: Codes of the characters below 0x10000; beyond, each is its own.
LETTERS = np.array([_letter(x) if x < 0xD800 or x > 0xDFFF else 0 for x in range(1 << 16)], np.uint32)


def letters(data: np.ndarray) -> np.ndarray:
    """The letter code at each first byte of a UTF-8 character, 0 at the others."""
    out = LETTERS[data]  # right for ASCII; bytes beyond it follow
    lead = np.flatnonzero(data >= 0x80)
    out[lead] = 0
    lead = lead[data[lead] >= 0xC2]
    tail = np.append(data, np.zeros(3, np.uint8)).astype(np.uint32) & 0x3F
    first = data[lead].astype(np.uint32)
    for low, high, bits, more in ((0xC2, 0xDF, 0x1F, 1), (0xE0, 0xEF, 0x0F, 2), (0xF0, 0xF4, 0x07, 3)):
        at = (first >= low) & (first <= high)
        place = first[at] & bits
        for k in range(1, more + 1):
            place = place << 6 | tail[lead[at] + k]
        out[lead[at]] = LETTERS[place] if more < 3 else place
    return out


def bits(codes: np.ndarray) -> np.ndarray:
    """One bit of 64 for a letter: a to z have their own, the others share the rest."""
    place = np.where(codes < 27, codes, 27 + codes % 37).astype(np.uint64)
    return np.where(codes > 0, np.uint64(1) << place, np.uint64(0))


class Words:
    """Of the texts in a column: words as letter codes, with the sentence and the text of each."""

    def __init__(self, column: pa.Array):
        raw, ends = text_buffer(column)
        lengths = np.diff(ends)
        n = self.n = len(lengths)
        own = raw[ends[0] : ends[-1]]
        data = np.full(len(own) + n, 0x20, np.uint8)
        data[np.arange(len(own), dtype=np.int64) + np.repeat(np.arange(n), lengths)] = own
        text_end = np.cumsum(lengths + 1)
        start, end = word_bounds(data, IS_SPACE)
        doc = np.searchsorted(text_end, start, "right")
        codes = letters(data)
        is_letter = codes > 0
        before = np.concatenate([[0], np.cumsum(is_letter)])
        lines = np.concatenate([[0], np.cumsum(data == 10)])
        opens = np.zeros(len(start), bool)
        if len(start):
            opens[0] = True
            opens[1:] = ENDS[data[end[:-1] - 1]] & (before[end[:-1]] - before[start[:-1]] > 1) | (lines[start[1:]] > lines[end[:-1]]) | (doc[1:] != doc[:-1])
        sentence = np.cumsum(opens) - 1
        a, b = before[start], before[end]
        some = b > a
        self.codes, a, b, doc, sentence = codes[is_letter], a[some], b[some], doc[some], sentence[some]
        single = b - a == 1
        edge = np.flatnonzero(np.diff(np.concatenate([[False], single, [False]]).astype(np.int8)))
        first, stop = edge[::2], edge[1::2]
        run = (stop - first >= 3) & (doc[first] == doc[np.maximum(stop - 1, 0)]) if len(first) else np.zeros(0, bool)
        first, stop = first[run], stop[run]
        self.start, self.end = np.concatenate([a, a[first]]), np.concatenate([b, b[stop - 1]])
        self.doc, self.sentence = np.concatenate([doc, doc[first]]), np.concatenate([sentence, sentence[first]])

    def masks(self, at: np.ndarray) -> np.ndarray:
        """The set of letters of each of some words, as bits."""
        if not len(at):
            return np.zeros(0, np.uint64)
        order = np.argsort(self.start[at])  # in their order, what lies between two words is short
        bounds = np.column_stack([self.start[at], self.end[at]])[order].ravel()
        out = np.empty(len(at), np.uint64)
        out[order] = np.bitwise_or.reduceat(np.append(bits(self.codes), np.uint64(0)), bounds)[::2]
        return out

    def padded(self, at: np.ndarray, width: int) -> np.ndarray:
        """The codes of some words, zeros after their ends."""
        place = np.arange(width)
        index = np.minimum(self.start[at, None] + place, len(self.codes) - 1)
        return np.where(place < (self.end - self.start)[at, None], self.codes[index], np.uint32(0))


def encoded(word: str) -> np.ndarray:
    codes = letters(np.frombuffer(word.encode(), np.uint8))
    return codes[codes > 0]


def decoded(codes: np.ndarray) -> str:
    return "".join(chr(96 + c) if c < 27 else chr(c) for c in codes.tolist() if c)


def subsequence_kernel(s: np.ndarray, t: np.ndarray) -> np.ndarray:
    """Gap-weighted common subsequences of ORDER letters of each row of s with the same row of t (or one row for all)."""
    n, rows, columns = len(s), s.shape[1], t.shape[1]
    same = ((s[:, :, None] == t[:, None, :]) & (s[:, :, None] > 0)).astype(np.float32)
    before = np.ones((n, rows + 1, columns + 1), np.float32)
    for _ in range(ORDER - 1):
        now = np.zeros_like(before)
        matched = DECAY**2 * same * before[:, :-1, :-1]
        across = np.zeros((n, rows, columns + 1), np.float32)
        for b in range(columns):
            across[:, :, b + 1] = DECAY * across[:, :, b] + matched[:, :, b]
        for a in range(rows):
            now[:, a + 1] = DECAY * now[:, a] + across[:, a]
        before = now
    return DECAY**2 * np.einsum("nab,nab->n", same, before[:, :-1, :-1])


def _self_kernel(rows: np.ndarray) -> np.ndarray:
    out = np.zeros(len(rows), np.float32)
    sizes = (rows > 0).sum(1)
    for size in np.unique(sizes):
        at = np.flatnonzero(sizes == size)
        for a in range(0, len(at), 2048):
            own = rows[at[a : a + 2048], :size]
            out[at[a : a + 2048]] = subsequence_kernel(own, own)
    return out


class Landmarks:
    def __init__(self, words: list[np.ndarray]):
        self.words = words
        self.masks = np.array([np.bitwise_or.reduce(bits(w)) for w in words], np.uint64)
        self.need = np.ceil(SHARE * np.bitwise_count(self.masks)).astype(int)
        self.sizes = np.array([len(w) for w in words])
        self.norms = np.array([_self_kernel(w[None])[0] for w in words])
        self.reach = 2 * self.sizes
        self.width = int(self.reach.max()) if words else 1
        self.most_known = CACHE
        self.forget()

    def forget(self) -> None:
        self.cache = np.zeros(0, np.uint64), np.zeros((0, len(self.words)), np.float32)

    def kernels(self, words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(word, landmark, value) wherever a landmark's kernel is taken and isn't 0."""
        size = words.end - words.start
        sound = np.flatnonzero((size >= ORDER) & (size <= self.width))
        if not len(sound) or not self.words:
            return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
        names, one, of = np.unique(word_hashes(words.codes, words.start[sound], words.end[sound]), return_index=True, return_inverse=True)
        values = self._values(names, words, sound[one])
        some = np.flatnonzero(values.any(1)[of])
        at, landmark = np.nonzero(values[of[some]])
        return sound[some[at]], landmark, values[of[some[at]], landmark]

    def _values(self, names: np.ndarray, words: Words, at: np.ndarray) -> np.ndarray:
        """A row of kernel values for each of some different words; names are their hashes, by which a worker's cache knows them."""
        known, rows = self.cache
        place = np.searchsorted(known, names)
        place[place == len(known)] = 0
        is_known = known[place] == names if len(known) else np.zeros(len(names), bool)
        out = np.zeros((len(names), len(self.words)), np.float32)
        out[is_known] = rows[place[is_known]]
        new = np.flatnonzero(~is_known)
        out[new] = self._computed(words, at[new])
        if len(known) + len(new) > self.most_known:
            known, rows = known[:0], rows[:0]
        if len(new) <= self.most_known:
            known, rows = np.concatenate([known, names[new]]), np.concatenate([rows, out[new]])
            order = np.argsort(known)
            self.cache = known[order], rows[order]
        return out

    def _computed(self, words: Words, at: np.ndarray) -> np.ndarray:
        out = np.zeros((len(at), len(self.words)), np.float32)
        size, masks = (words.end - words.start)[at], words.masks(at)
        near = [np.flatnonzero((np.bitwise_count(masks & m) >= need) & (size <= reach)) for m, need, reach in zip(self.masks, self.need, self.reach)]
        some = np.unique(np.concatenate(near))
        if not len(some):
            return out
        rows = words.padded(at[some], self.width)
        norms = _self_kernel(rows)
        for j, own in enumerate(near):
            own = own[np.argsort(size[own], kind="stable")]
            for a in range(0, len(own), 2048):
                part = own[a : a + 2048]
                row = np.searchsorted(some, part)
                value = subsequence_kernel(rows[row, : size[part[-1]]], self.words[j][None])
                out[part, j] = value / np.sqrt(np.maximum(norms[row] * self.norms[j], 1e-30))
        return out

    def sentences(self, words: Words) -> tuple[np.ndarray, np.ndarray]:
        """The text of each sentence that has any kernel value, and a row of its largest values."""
        word, landmark, value = self.kernels(words)
        if not len(word):
            return np.zeros(0, np.int64), np.zeros((0, len(self.words)), np.float32)
        found, one, of = np.unique(words.sentence[word], return_index=True, return_inverse=True)
        rows = np.zeros((len(found), len(self.words)), np.float32)
        np.maximum.at(rows, (of, landmark), value.astype(np.float32))
        return words.doc[word[one]], rows


def _machine(x: np.ndarray, y: np.ndarray, weight: np.ndarray, cost: float) -> np.ndarray:
    """A linear machine with squared hinge loss, by Newton's method on the active rows; the last weight is the bias.

    The last column of x is 1. Sums are taken over some rows at a time.
    """
    w = np.zeros(x.shape[1])
    ridge = np.eye(len(w))
    ridge[-1, -1] = 1e-3
    active = np.ones(len(x), bool)
    for _ in range(50):
        square, product = ridge.copy(), np.zeros(len(w))
        at = np.flatnonzero(active)
        for a in range(0, len(at), 4096):
            own = at[a : a + 4096]
            rows, c = x[own].astype(float), cost * weight[own]
            square += rows.T @ (c[:, None] * rows)
            product += rows.T @ (c * y[own])
        w = np.linalg.solve(square, product)
        now = y * (x @ w.astype(np.float32)) < 1
        if np.array_equal(now, active):
            break
        active = now
    return w


class Model:
    """Landmarks, the machine's weights on kernel values, the logistic function's weights, and the calibration's knots."""

    def __init__(self, texts: list[str], toxic: np.ndarray, n_landmarks: int = LANDMARKS, cost: float = COST):
        self.landmarks = Landmarks([])
        self.weights, self.bias, self.evidence, self.knots = np.zeros(0), 0.0, np.zeros(5), (np.zeros(0), np.zeros(0))
        if not len(texts) or toxic.all() or not toxic.any():
            return
        chosen = _choose(texts, toxic, n_landmarks)
        if not chosen:
            return
        first = len(chosen)
        self.landmarks = marks = Landmarks(_spread([*chosen, *_nearest(chosen, texts, toxic)], first + NEAR, first))
        rng = np.random.default_rng(SEED)
        spoilt = [_inserted(w, rng) for w in chosen for _ in range(8)]
        _, extra = marks.sentences(Words(pa.array([decoded(w) + "." for w in spoilt], pa.string())))
        found, n_sentences, sizes = [], 0, []
        for start, words in _blocks(texts):
            doc, rows = marks.sentences(words)
            found.append((doc + start, rows))
            n_sentences += int(words.sentence.max()) + 1 if len(words.sentence) else 0
            sizes.append(np.bincount(words.doc, minlength=words.n))
        doc, rows = (np.concatenate(x) for x in zip(*found))
        sizes = np.concatenate(sizes)
        matrix = np.array([[subsequence_kernel(a[None], b[None])[0] for b in marks.words] for a in marks.words]) / np.sqrt(np.outer(marks.norms, marks.norms))
        values, vectors = np.linalg.eigh((matrix + matrix.T) / 2)
        root = (vectors / np.sqrt(np.maximum(values, LEAST))) @ vectors.T
        del words
        marks.forget()
        root32 = root.astype(np.float32)
        many_more = len(extra)
        top = rows[:, :first].max(1, initial=0)
        x = np.ones((len(doc) + many_more + 1, rows.shape[1] + 1), np.float32)
        x[: len(doc), :-1], x[len(doc) : -1, :-1], x[-1, :-1] = rows @ root32, extra @ root32, 0
        del rows, extra
        positive = toxic[doc]
        n_plain = n_sentences - len(doc)
        score = top
        for _ in range(ROUNDS):
            order = np.lexsort((-score, doc))
            place = np.arange(len(doc)) - np.maximum.accumulate(np.where(np.concatenate([[True], doc[order][1:] != doc[order][:-1]]), np.arange(len(doc)), 0)) if len(doc) else np.zeros(0, int)
            stands = np.zeros(len(doc), bool)
            stands[order[place < STAND]] = True
            stands &= positive & (top > 0.5)
            many = max(1, int(stands.sum()))
            y = np.concatenate([np.where(stands, 1.0, -1.0), np.ones(many_more), [-1.0]])
            weight = np.concatenate([(stands | ~positive).astype(float), np.full(many_more, 0.5 * many / max(1, many_more)), [min(n_plain, 5 * many)]])
            w = _machine(x, y, weight, cost)
            score = x[: len(doc)] @ w.astype(np.float32)
        self.weights, self.bias = root @ w[:-1], float(w[-1])
        facts = self._facts(sizes, doc, score)
        self.evidence = _logistic(facts, toxic.astype(float))
        self.knots = isotonic(self._evidence(facts), toxic.astype(float), np.ones(len(toxic)))

    def _facts(self, sizes: np.ndarray, doc: np.ndarray, score: np.ndarray) -> np.ndarray:
        """Of each text: its highest sentence score, the sums of scores above two margins (logarithms), and its words (log)."""
        most, sums = np.full(len(sizes), self.bias), np.zeros((2, len(sizes)))
        np.maximum.at(most, doc, score)
        for total, margin in zip(sums, MARGINS):
            np.add.at(total, doc, np.maximum(0, score - margin))
        return np.column_stack([np.clip(most, -2, 3), *np.log(sums + 0.05), np.log1p(sizes)])

    def _evidence(self, facts: np.ndarray) -> np.ndarray:
        return facts @ self.evidence[:-1] + self.evidence[-1]

    def scores(self, column: pa.Array) -> np.ndarray:
        if not len(self.knots[0]):
            return np.full(len(column), 0.5)
        words = Words(column)
        doc, rows = self.landmarks.sentences(words)
        return calibrated(self._evidence(self._facts(np.bincount(words.doc, minlength=words.n), doc, rows @ self.weights + self.bias)), self.knots)


def _inserted(word: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """The word with a letter inserted, or two if it is a longer one."""
    n = 1 + (len(word) > 6)
    return np.insert(word, np.sort(rng.integers(1, len(word), n)), rng.integers(1, 27, n))


def _logistic(x: np.ndarray, y: np.ndarray, rounds: int = 50) -> np.ndarray:
    """Weights and bias of a logistic function, lightly regularised, by Newton's method."""
    x = np.column_stack([x, np.ones(len(x))])
    w = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve(x.T @ ((p * (1 - p))[:, None] * x) + 0.1 * np.eye(len(w)), x.T @ (y - p) - 0.1 * w)
        w += step
        if np.abs(step).max() < 1e-6:
            break
    return w


def _spread(candidates: list[np.ndarray], most: int, first: int = 0) -> list[np.ndarray]:
    """The first ones, and of the others in turn those that are not too close to one before."""
    out = candidates[:first]
    norms = [float(_self_kernel(w[None])[0]) for w in out]
    for word in candidates[first:]:
        if len(out) >= most:
            break
        own = float(_self_kernel(word[None])[0])
        if all(float(subsequence_kernel(word[None], w[None])[0]) <= CLOSE * np.sqrt(own * norm) for w, norm in zip(out, norms)):
            out.append(word)
            norms.append(own)
    return out


def _blocks(texts: list[str]) -> Iterator[tuple[int, Words]]:
    """The words of some texts at a time, and the number of the first of these texts."""
    for a, b in row_blocks([len(t) for t in texts], TRAIN_BYTES):
        yield a, Words(pa.array(texts[a:b], pa.string()))
        release()


def _nearest(chosen: list[np.ndarray], texts: list[str], toxic: np.ndarray) -> list[np.ndarray]:
    """The other rows' words, nearest to any chosen word first."""
    marks, best = Landmarks(chosen), {}
    for start, words in _blocks(texts):
        word, _, value = marks.kernels(words)
        some = (value > 0.3) & ~toxic[words.doc[word] + start]
        for w, v in zip(word[some].tolist(), value[some].tolist()):
            name = words.codes[words.start[w] : words.end[w]].tobytes()
            best[name] = max(v, best.get(name, 0.0))
    marks.forget()
    near = (x for x in best if best[x] <= CLOSE)  # the others are too close to be landmarks
    return [np.frombuffer(x, np.uint32) for x in sorted(near, key=lambda x: (-best[x], x))]


def _tally(texts: list[str], toxic: np.ndarray, spans: Callable[[Words], tuple[np.ndarray, np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """(hash, worth) of the letter runs that spans gives of some texts' words (starts, ends and texts): the toxic rows that hold
    a run, times the logarithm of how much more often than others they do, less one deviation; 0 if that is under ODDS."""
    counts = [(np.zeros(0, np.uint64), np.zeros(0), np.zeros(0))]
    for first, words in _blocks(texts):
        start, end, doc = spans(words)
        if not len(start):
            continue
        h = word_hashes(words.codes, start, end)
        order = np.lexsort((doc, h))
        h, doc = h[order], doc[order]
        once = np.ones(len(h), bool)
        once[1:] = (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])
        name, of = np.unique(h[once], return_inverse=True)
        counts.append((name, np.bincount(of, weights=toxic[doc[once] + first], minlength=len(name)), np.bincount(of, minlength=len(name))))
    names, of = np.unique(np.concatenate([c[0] for c in counts]), return_inverse=True)
    k, every = (np.bincount(of, weights=np.concatenate([c[i] for c in counts]), minlength=len(names)) for i in (1, 2))
    p, q = (k + 0.5) / (toxic.sum() + 1), (every - k + 0.5) / ((~toxic).sum() + 1)
    bound = np.log(p / q) - np.sqrt(1 / (k + 0.5) + 1 / (every - k + 0.5))
    return names, np.where((k >= 3) & (bound > ODDS), k * bound, 0.0)


def _choose(texts: list[str], toxic: np.ndarray, n: int) -> list[np.ndarray]:
    """Words, and beginnings that several of them share, that toxic rows hold much more often than others."""

    def whole(words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        size = words.end - words.start
        at = np.flatnonzero((size > ORDER) & (size <= LONGEST))
        return words.start[at], words.end[at], words.doc[at]

    names, worth = _tally(texts, toxic, whole)
    good = np.flatnonzero(worth > 0)
    odds, spelled = dict(zip(names[good].tolist(), worth[good].tolist())), {}
    for _, words in _blocks(texts):
        start, end, _ = whole(words)
        one, first = np.unique(word_hashes(words.codes, start, end) if len(start) else np.zeros(0, np.uint64), return_index=True)
        for i in first[np.isin(one, names[good])].tolist():
            word = words.codes[start[i] : end[i]]
            spelled[tuple(word.tolist())] = odds[int(word_hashes(word, np.array([0]), np.array([len(word)]))[0])]
    shared = Counter(w[:size] for w in spelled for size in range(ORDER + 1, len(w)))
    stems = {w: w for w, many in shared.items() if many >= STEM}
    for size in sorted({len(w) for w in stems}):

        def begun(words: Words, size: int = size) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
            at = np.flatnonzero(words.end - words.start >= size)
            return words.start[at], words.start[at] + size, words.doc[at]

        own = [np.array(w, np.uint32) for w in stems if len(w) == size]
        found = dict(zip(*(x.tolist() for x in _tally(texts, toxic, begun))))
        for w in own:
            value = found[int(word_hashes(w, np.array([0]), np.array([size]))[0])]
            if value > 0:
                spelled[tuple(w.tolist())] = max(value, spelled.get(tuple(w.tolist()), value))
    return _spread([np.array(w, np.uint32) for w in sorted(spelled, key=lambda w: (-spelled[w], w))], n)


def fit(
    docs: DataFrame, labels: DataFrame, label: str = "toxic", learn: Column | None = None, key: str = "doc_id", text: str = "text", train_rows: int = TRAIN_ROWS, train_bytes: int = SAMPLE_BYTES
) -> Model:
    """Learn from about train_rows of the labelled rows for which learn, a condition on ``key``, holds; from fewer, if their
    texts, which are taken whole, have more than train_bytes."""
    known = labels.filter(F.col(label).isNotNull())
    known = known.filter(learn) if learn is not None else known
    known = known.select(F.col(key).alias("key"), (F.col(label) > 0).alias("toxic"))
    n = known.count()
    if not n:
        return Model([], np.zeros(0, bool))

    def chosen(rows: DataFrame, share: float) -> DataFrame:
        return rows.filter(F.pmod(F.xxhash64("key"), F.lit(1 << 20)) < F.lit(int(share * (1 << 20)) + 1))

    slim = docs.select(F.col(quoted(key)).alias("key"), F.col(quoted(text)).cast("string").alias("text"))
    share = min(1.0, train_rows / n)
    sample = checkpointed(slim.join(chosen(known, share), "key"))  # a table of about train_rows rows
    size = sample.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    rows = chosen(sample, share * min(1.0, train_bytes / max(1, size))).sort("key", "text").toArrow()  # both bounds are documented
    return Model([t or "" for t in rows["text"].to_pylist()], rows["toxic"].to_numpy().astype(bool))


def score(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text", carry: bool = False) -> DataFrame:
    """key, score (0 to 1) of every row. carry: a struct ``row`` of all of the row's columns comes along."""
    model.landmarks.forget()
    shared = docs.sparkSession.sparkContext.broadcast(model)  # some landmarks, weights and knots
    # the text comes once: in the row, where that comes along
    slim = docs.select(F.col(quoted(key)).alias("key"), row_of(docs) if carry else F.col(quoted(text)).cast("string").alias("text"))
    fields = [f for f in slim.schema if f.name != "text"]
    place = docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            texts = batch.column(1).field(place).cast(pa.string()) if carry else batch.column(1)
            for a, b in row_blocks(np.diff(text_buffer(texts)[1]).tolist(), SHARD_BYTES):
                scores = pa.array(model.scores(texts.slice(a, b - a)))
                yield pa.RecordBatch.from_arrays([*batch.slice(a, b - a).columns[: 1 + carry], scores], [*(f.name for f in fields), "score"])
            release()
        model.landmarks.forget()
        release()

    return slim.mapInArrow(run, with_fields(fields, "score double")).withColumnRenamed("key", key)
