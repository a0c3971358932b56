"""The kernel is taken up to the documented length: twice the landmark's."""

import pyarrow as pa
import pytest

from askmine.llm import toxicity

PLAIN = "the ringing on heaters. %s in the house ander on. "


@pytest.mark.parametrize(
    ("landmark", "words"),
    [("idiot", ["idiotface", "totalidiot", "idiotidiot", "idiooooot", "ixdxixoxt"]), ("stupid", ["stupidstupid", "stuuuuuupid", "sxtxuxpxixd", "sostupidface"])],
)
def test_glued_stretched_and_interleaved_words_are_compared(landmark, words):
    marks = toxicity.Landmarks([toxicity.encoded(landmark)])
    own = toxicity._self_kernel(toxicity.encoded(landmark)[None])[0]
    for word in [landmark, *words]:
        _, _, value = marks.kernels(toxicity.Words(pa.array([word])))
        code = toxicity.encoded(word)[None]
        expected = toxicity.subsequence_kernel(code, toxicity.encoded(landmark)[None])[0] / (own * toxicity._self_kernel(code)[0]) ** 0.5
        assert len(value) == 1 and value[0] == pytest.approx(expected, rel=1e-4) and value[0] > 0
    assert len(marks.kernels(toxicity.Words(pa.array([landmark * 2 + "x"])))[0]) == 0


def test_glued_insults_are_scored():
    texts = [(PLAIN % (f"idiot {i}" if i % 4 == 0 else f"ringer {i}")) for i in range(240)]
    model = toxicity.Model(texts, pa.array([i % 4 == 0 for i in range(240)]).to_numpy(zero_copy_only=False))
    score = lambda w: float(model.scores(pa.array([PLAIN % w]))[0])
    assert all(score(w) >= 0.7 for w in ("idiot", "idiotidiot", "idiotface")) and score("ringer") < 0.5
