import base64

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from samples import HARD

from postlake.llm import bpe as B
from postlake.llm.queries import tokenizer_file

tiktoken = pytest.importorskip("tiktoken")


@pytest.fixture(scope="module")
def reference():
    path, pattern = tokenizer_file()
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}
    return tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def own():
    return B.ByteBpe(*B.vocabulary(*tokenizer_file()))


@settings(max_examples=300, deadline=None)
@given(st.text(st.one_of(st.characters(exclude_categories=["Cs"]), st.sampled_from("  \n\t's'reabc\x1c\x85\xa0")), max_size=60))
def test_any_text(reference, own, text):
    ids = own.encode(text)
    assert list(np.frombuffer(ids, "<u4")) == reference.encode_ordinary(text)
    assert own.decode(ids) == text.encode()


def test_every_entry_is_reached(own):
    assert all(own.encode_all([t.decode()])[0] for t in list(own.entries)[:200] if t.isascii() and t.strip())
    assert [own.decode(np.array([r], "<u4").tobytes()) for r in (0, 300, 50_000)] == [
        next(t for t, k in own.entries.items() if k == r) for r in (0, 300, 50_000)
    ]


def test_bounded_memory_changes_nothing(reference, monkeypatch):
    monkeypatch.setattr(B, "REMEMBERED", 3)
    small = B.ByteBpe(*B.vocabulary(*tokenizer_file()))
    for text in ("one two three four", "five six seven one", "one two nine"):
        assert list(np.frombuffer(small.encode(text), "<u4")) == reference.encode_ordinary(text)


def test_hard_rows(spark, hard, empty, reference):
    rows = B.byte_bpe(hard.withColumnRenamed("n_chars", "n_tokens"), *tokenizer_file()).collect()
    assert len(rows) == len(HARD)
    for r in rows:
        assert list(np.frombuffer(bytes(r.ids), "<u4")) == reference.encode_ordinary(r.text or "")
        assert bytes(r.decoded) == (r.text or "").encode() and r.n_tokens == len(r.ids) // 4
    tokens = B.byte_bpe(hard, *tokenizer_file(), decode=False)
    assert all(bytes(r.decoded) == (r.text or "").encode() for r in B.byte_bpe_decode(tokens, *tokenizer_file()).collect())
    assert B.digests(B.byte_bpe(empty, *tokenizer_file())).count() == 0


def test_incomplete_vocabulary_is_refused():
    with pytest.raises(ValueError, match="single bytes"):
        B.serialise_model({b"a": 0, b"b": 1})
