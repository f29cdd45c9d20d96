import math
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F
from samples import HARD

from postlake.llm import ngram_lm as L
from postlake.llm.eliasfano import EliasFano, Trie


def brute(rows):
    """rows of (doc_id, text, trained) -> per row the result columns."""
    unigrams, bigrams, texts = Counter(), Counter(), []
    for _, text, trained in rows:
        words = [*(text or "").encode().lower().split(), None]
        texts.append(words)
        if trained:
            unigrams.update(words)
            bigrams.update(zip([None, *words[:-1]], words))
    n, v = sum(unigrams.values()), len(unigrams)
    out = []
    for (doc_id, _, trained), words in zip(rows, texts):
        base = score = 0.0
        for context, word in zip([None, *words[:-1]], words):
            p = (unigrams[word] + 1) / (n + v + 1)
            base += math.log10(p)
            score += math.log10((bigrams[context, word] + L.MU * p) / (unigrams[context] + L.MU))
        out.append((doc_id, not trained, len(words), sum(unigrams[w] > 0 for w in words), n, base, score))
    return out


def compare(got, want):
    assert len(got) == len(want)
    key = lambda r: (repr(r[:5]), round(r[5], 6))
    for a, b in zip(sorted(map(tuple, got), key=key), sorted(want, key=key)):
        assert a[:5] == b[:5]
        assert a[5] == pytest.approx(b[5], abs=1e-6)
        assert abs(a[6] - b[6]) <= a[2] / L.STEPS


@pytest.mark.parametrize("small", [False, True])
def test_hard_rows(spark, hard, monkeypatch, small):
    if small:  # several blocks, and contexts spread over shards
        monkeypatch.setattr(L, "BLOCK_TOKENS", 50)
        monkeypatch.setattr(L, "CONTEXT_TOKENS", 3)
    got = L.score_texts(hard, F.col("source") != "src1").collect()
    compare(got, brute([(r[0], r[1], r[3] != "src1") for r in HARD]))


def test_nothing_learned_and_empty(spark, hard, empty):
    got = L.score_texts(hard, F.lit(False)).collect()
    assert {(r.n_known, r.train_tokens, r.base_score, r.score) for r in got} == {(0, 0, 0.0, 0.0)}
    assert L.score_texts(empty, F.lit(True)).count() == 0


def test_held_out_texts_score_better_than_by_single_words(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = L.score_texts(docs, F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 != 2).where("held_out").collect()
    assert sum(r.score for r in rows) > sum(r.base_score for r in rows)


@pytest.mark.parametrize("size", [1, 2, 63, 64, 65, 5_000, 150_000])
def test_elias_fano(tmp_path, size):
    rng = np.random.default_rng(size)
    values = np.unique(rng.integers(0, 2 ** int(rng.integers(8, 40)), size)).astype(np.uint64)
    built = EliasFano.build(values)
    built.save(str(tmp_path), "x")
    mapped = EliasFano.load(str(tmp_path), "x")
    assert (mapped.decode(0, len(mapped.places)) == values).all()
    places = np.arange(0, len(values), 3)
    assert (mapped.take(places) == values[places]).all()
    keys = np.unique(np.concatenate([values[::2], rng.integers(0, 2**40, 100).astype(np.uint64)]))
    known = {int(v): i for i, v in enumerate(values)}
    assert mapped.find(keys).tolist() == [known.get(int(k), -1) for k in keys]


def test_trie_finds_only_successors_of_the_context(tmp_path):
    contexts, sizes, words = np.array([2, 5, 9]), np.array([2, 1, 3]), np.array([0, 7, 3, 0, 1, 1000])
    Trie.save(str(tmp_path), contexts, sizes, words, np.arange(6, dtype=np.uint16))
    asked = {1: [0], 2: [0, 1, 7, 8, 9], 5: [0, 3, 4], 9: [0, 1, 2, 1000, 1001], 10: [5]}
    got = Trie(str(tmp_path)).query(
        np.array(list(asked)), np.array([len(w) for w in asked.values()]), np.concatenate(list(map(np.array, asked.values()))), 99
    )
    assert got.tolist() == [99, 0, 99, 1, 99, 99, 99, 2, 99, 3, 4, 99, 5, 99, 99]


def test_null_id_beside_large_ids(spark):
    """Ids that floating point cannot hold, in one block with a null id."""
    ids = [2**60 + 1, None, -(2**62) - 1, 2**63 - 1]
    frame = spark.createDataFrame([(i, "some words") for i in ids], "doc_id long, text string").coalesce(1)
    got = [r.doc_id for r in L.score_texts(frame, F.lit(True)).collect()]
    assert sorted(got, key=repr) == sorted(ids, key=repr)
