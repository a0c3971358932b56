"""Queries over whole tables against brute-force versions."""

import hashlib
import re
from collections import Counter

import numpy as np

from askmine.operators import embedding
from askmine.plans import queries


def _held_out(thread):
    return int.from_bytes(hashlib.sha256(f"42:{thread}".encode()).digest()[:8], "big") / 2**64 < 0.1


def _runs(text):
    words = re.findall(r"[^\W\d_]+", text.lower())
    return {" ".join(words[i : i + 5]) for i in range(len(words) - 4)}


def test_holdout_queries_name_near_duplicates(spark, tmp_path):
    rng = np.random.default_rng(5)
    words = [f"{a}{b}" for a in ("lion", "drum", "song", "hall", "date") for b in ("a", "er", "ing", "s", "")]
    prose = lambda n: " ".join(rng.choice(words, n))
    common, rows = prose(12), []
    for i in range(200):
        own = prose(30)
        rows += [(i, 0, "user", f"{own} {common}"), (i, 1, "assistant", prose(20))]
        if i % 3 == 0:  # asked again in another thread, in part or (below the share) in a lesser part
            rows.append((1000 + i, 0, "user", " ".join(own.split()[: 26 if i % 2 else 14]) + " " + prose(8)))
        elif i % 3 == 1:  # said again in the same thread only
            rows.append((i, 2, "user", own))
    spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").write.parquet(str(tmp_path / "conversations.parquet"))
    runs = {(c, t): _runs(x) for c, t, _, x in rows}
    seen = Counter(r for x in runs.values() for r in x)
    want = {}
    for c, t, _, _ in rows:
        if t == 0 and _held_out(c):
            rare = {r for r in runs[c, t] if seen[r] <= 20}
            most = max(len(rare & x) for (d, _), x in runs.items() if d != c)
            want[str(c)] = "near_duplicate" if most and most >= 0.5 * len(rare) else ""
    got = {r["thrid"]: r["reason"] for r in queries.holdout_queries(spark, str(tmp_path)).collect()}
    assert got == want and Counter(want.values())["near_duplicate"] >= 5 and Counter(want.values())[""] >= 5


def _n_chunks(body):
    """The chunks of a body, one piece at a time."""
    total = len(body.split())
    if total <= 300:
        return int(total > 0)
    pieces = []
    for paragraph in re.split(r"\n\s*\n", body):
        sentences = [paragraph] if len(paragraph.split()) <= 300 else re.split(r"(?<=[.!?])\s+", paragraph)
        for n in (len(s.split()) for s in sentences):
            parts = -(-n // 300)
            step = -(-n // parts) if n else 1
            pieces += [min(step, n - i) for i in range(0, n, step)]
    enough, found, size = -(-total // -(-total // 300)), 0, 301
    for n in pieces:
        if size + n > 300 or size >= enough:
            found, size = found + 1, 0
        size += n
    return found


def test_chunks_of_all_documents_are_counted(spark, tmp_path):
    rng = np.random.default_rng(6)
    sentence = lambda n: " ".join(["word"] * n) + "."
    texts = ["", None, " \n", "one", sentence(300), sentence(301), sentence(650), "\n\n".join(sentence(90) for _ in range(9))]
    texts += ["\n\n".join(" ".join(sentence(int(n)) for n in rng.integers(1, 120, rng.integers(1, 9))) for _ in range(rng.integers(1, 7))) for _ in range(60)]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    want = Counter((len((x or "").split()), _n_chunks(x or "")) for x in texts)
    got = {(r["n_words"], r["n_chunks"]): r["n_docs"] for r in queries.QUERIES["all_chunk_counts"](spark, str(tmp_path)).collect()}
    assert got == want and max(n for _, n in want) > 4


def test_chunk_vectors_tell_the_vectors(spark, tmp_path):
    texts = ["three lions came to the hall", "to the hall came lions three", "three drums came to the hall", " ".join(f"word{i}" for i in range(650))]
    keys = [i for i in range(100) if not _held_out(i)][: len(texts)]
    spark.createDataFrame(list(zip(keys, texts, ["src"] * 4)), "doc_id long, text string, source string").write.parquet(str(tmp_path / "documents.parquet"))
    got = {(int(r["id"]), r["chunk_index"]): r for r in queries.QUERIES["chunk_vectors"](spark, str(tmp_path)).collect()}
    assert sorted(got) == [(k, 0) for k in keys] + [(keys[3], 1), (keys[3], 2)]
    parts = {(k, 0): x for k, x in zip(keys, texts[:3])} | {(keys[3], i): " ".join(x) for i, x in enumerate(np.array_split(texts[3].split(), [217, 434]))}
    for at, text in parts.items():
        (vector,) = embedding.HashedTerms()([text])
        unit = (np.array(vector) / np.linalg.norm(vector)).astype(np.float32).astype(float)
        assert got[at]["vector_sha256"] == hashlib.sha256(",".join(str(int(x)) for x in np.rint(unit * 2**30)).encode()).hexdigest()
    digests = [got[k, 0]["vector_sha256"] for k in keys]
    assert digests[0] == digests[1] and len(set(digests)) == 3
