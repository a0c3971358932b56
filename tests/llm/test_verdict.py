"""The verdict on repetition against a plain count of repeats, in texts of any length."""

import numpy as np

from askmine.llm import repetition


def brute(words):
    """(words in repeats of eight or more, words of the longest repeat)."""
    n = len(words)
    longest, gone = 0, set()
    common = np.zeros((n + 1, n + 1), int)
    for i in range(n - 1, -1, -1):
        for j in range(n - 1, i, -1):
            if words[i] == words[j]:
                common[i, j] = common[i + 1, j + 1] + 1
    for i in range(n):
        m = max(common[i].max(), common[:, i].max())
        if m >= 8:
            longest = max(longest, m)
            gone.update(range(i, i + m))
    return len(gone), int(longest)


def test_kept_by_covered_share_and_longest_repeat(spark):
    rng = np.random.default_rng(6)
    prose = lambda n: [f"w{x}" for x in rng.integers(0, 5000, n)]
    texts = []
    for size, again in ((60, 0), (60, 10), (60, 28), (120, 40), (120, 49), (300, 50), (300, 51), (700, 52), (700, 20), (49, 0)):
        words = prose(size)
        texts.append(" ".join(words + words[5 : 5 + again]))
    texts += [None, "", "a b " * 60]
    rows = repetition.judge(repetition.measure(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))).collect()
    for r in rows:
        words = (texts[r["doc_id"]] or "").split()
        n_covered, longest = brute(words)
        assert (r["n_covered"], r["longest"] if longest else 0) == (n_covered, longest)
        assert r["kept"] == (not r["base_failed"] and n_covered <= 0.4 * len(words) and longest <= 50)
    assert {r["doc_id"] for r in rows if not r["kept"]} == {2, 3, 4, 6, 7, 9, 10, 11, 12}
