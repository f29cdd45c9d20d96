"""Each stage on its own input, and the whole against plain Python."""

import numpy as np
from samples import DOCUMENTS, HARD
from test_units import brute

import corpus_pipeline as P
from postlake.session import stage

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def through(spark, docs):
    out = [docs]
    for name, function in P.STAGES:
        out.append(stage(function(spark, out[-1], "unused"), name))
    return out


def test_stages_take_effect(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    raw, rated, thin, cut, mixed, tokens = through(spark, docs)
    assert [name for name, _ in P.STAGES] == ["quality_rules", "ngram_jaccard_join", "substring_dedup", "source_mixture", "byte_bpe"]
    assert all(x.columns == COLUMNS for x in (rated, thin, cut, mixed))
    kept, one = {r.doc_id: r.text for r in rated.collect()}, {r.doc_id: r.text for r in thin.collect()}
    assert 0 < len(one) < len(kept) < docs.count()

    def shingles(text):
        words = text.encode().lower().split()
        return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}

    def similar(a, b):
        return len(a & b) >= 0.8 * len(a | b)

    sets = {i: shingles(t) for i, t in kept.items()}
    ids = sorted(one)
    assert not any(similar(sets[i], sets[j]) for n, i in enumerate(ids) for j in ids[:n])
    assert all(any(similar(sets[i], sets[j]) for j in sets if j < i) for i in set(kept) - set(one))
    after = {r.doc_id: r.text for r in cut.collect()}
    gone = brute([(i, one[i]) for i in ids])
    for i in ids:
        left = [w for at, w in enumerate(one[i].split()) if at not in gone[i]]
        assert left == after.get(i, "").split() and (left or i not in after)
    assert any(gone.values())
    chosen = [r.doc_id for r in mixed.collect()]
    assert set(chosen) <= set(after) and max(chosen.count(i) for i in set(chosen)) <= 2
    rows = tokens.collect()
    assert len(rows) == len(chosen) and all(r.exact and r.n_tokens == len(r.ids) // 4 for r in rows)


def test_run_equals_stages(spark):
    a = P.run(spark, "/root/testdata/sf0.001").select("doc_id", "n_tokens", "ids").collect()
    b = through(spark, spark.read.parquet("/root/testdata/sf0.001/documents.parquet"))[-1].select("doc_id", "n_tokens", "ids").collect()
    key = lambda r: (r.doc_id, r.n_tokens, bytes(r.ids))
    assert sorted(map(key, a)) == sorted(map(key, b)) and np.all([r.n_tokens >= 0 for r in a])


def test_hard_rows_and_empty(spark, empty):
    for docs in (spark.createDataFrame(HARD, DOCUMENTS), empty):
        through(spark, docs)[-1].count()
        for _, function in P.STAGES:
            function(spark, docs, "unused").count()
