"""Encoding and decoding in one worker gives what the two operators give one after the other."""

import public_tokenizers
from test_llm_operators import docs, empty  # noqa: F401

from askmine.llm import bpe
from askmine.llm.queries import RANK_FILE


def test_one_worker(docs, empty):  # noqa: F811
    path = public_tokenizers.path(RANK_FILE)
    rows = lambda df: sorted(map(str, df.select("doc_id", "ids", "n_tokens", "decoded").collect()))
    assert rows(bpe.round_trip(docs, path)) == rows(bpe.decode(bpe.encode(docs, path), path)) != []
    assert bpe.round_trip(empty, path).count() == 0
