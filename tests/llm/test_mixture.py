import hashlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F
from samples import HARD

from postlake.llm import mixture as M

WEIGHTS = M.Weights(domain={"d0": 3}, lang={"en": 4}, source={"src0": 2})


def brute(leaves, budget, epochs):
    """leaves: path -> tokens. Budgets by taking out full children until none is."""
    def weight(level, name):
        return getattr(WEIGHTS, M.LEVELS[level]).get(name, 1)

    def share(prefix, budget):
        depth = len(prefix)
        if depth == 3:
            return {prefix: budget}
        caps = defaultdict(int)
        for path, tokens in leaves.items():
            if path[:depth] == prefix:
                caps[path[depth]] += tokens * epochs
        left, open_, given = budget, dict(caps), {}
        while open_:
            total = sum(weight(depth, c) for c in open_)
            full = [c for c in open_ if open_[c] * total <= weight(depth, c) * left]
            if not full:
                given |= {c: left * weight(depth, c) // total for c in open_}
                break
            first = min(full, key=lambda c: open_[c] / weight(depth, c))
            given[first] = open_.pop(first)
            left -= given[first]
        return {p: q for c, b in given.items() for p, q in share((*prefix, c), b).items()}

    return share((), min(budget, sum(leaves.values()) * epochs))


def check(spark, rows, percent, epochs):
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, domain string, copies string")
    got = M.mix(frame, F.col("d") if "d" in frame.columns else F.concat(F.lit("d"), F.col("doc_id") % 2), percent, WEIGHTS, epochs).collect()
    leaves = defaultdict(list)
    for doc_id, text, lang, source, *_ in rows:
        domain = None if doc_id is None else f"d{doc_id % 2}"
        leaves[domain, lang, source].append((doc_id, len((text or "").encode().split())))
    tokens = {path: sum(n for _, n in docs) for path, docs in leaves.items()}
    quotas = brute(tokens, sum(tokens.values()) * percent // 100, epochs)
    want = []
    for path, docs in leaves.items():
        if not tokens[path]:
            continue
        whole, rest = divmod(quotas[path], tokens[path])
        key = lambda d: hashlib.md5(f"17:{whole}:{'' if d is None else d}".encode()).hexdigest()  # noqa: E731,B023
        at = 0
        for doc_id, n in sorted(docs, key=lambda x: key(x[0])):
            at += n
            if whole + (at <= rest):
                want.append((doc_id, *path, n, whole + (at <= rest)))
    have = sorted(((r.doc_id, r.domain, r.lang, r.source, r.n_tokens, r.copies) for r in got), key=repr)
    assert have == sorted(want, key=repr)
    return have


def test_budgets_shortages_and_epochs(spark, monkeypatch):
    monkeypatch.setattr(M, "BUCKET_DOCS", 3)
    rows = [(i, " ".join(["w"] * (1 + i * 7 % 23)), ["en", "de", None][i % 3], f"src{i % 4 * (i % 5 > 0)}", None, None) for i in range(150)]
    for percent, epochs in ((30, 1), (100, 1), (100, 2), (170, 2), (500, 2)):
        assert check(spark, rows, percent, epochs)


def test_hard_rows(spark, empty):
    rows = [(r[0], r[1], r[2], r[3], None, None) for r in {(h[0], h[1]): h for h in HARD}.values()]
    check(spark, rows, 60, 2)
    assert M.mix(empty, F.lit("d"), 50, WEIGHTS).count() == 0


def test_copies_become_rows(spark):
    frame = spark.createDataFrame([(1, "a b", "en", "s")], "doc_id long, text string, lang string, source string")
    assert M.repeated(M.mix(frame, F.lit("d"), 200, WEIGHTS, 3)).count() == 2


def test_weight_of_nothing(spark):
    """Sources, languages and domains of weight 0 stay out, also when the rest is short."""
    rows = [(i, "w " * (i % 5), ["en", "de"][i % 2], f"src{i % 3}", ["web", "books"][i % 4 // 2]) for i in range(60)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, domain string")
    for weights in (M.Weights(source={"src1": 0}), M.Weights(lang={"de": 0}, source={"src0": 3}), M.Weights(domain={"web": 0}),
                    M.Weights(source={"src2": 5, "src0": 1}, default=0), M.Weights(default=0)):
        got = M.mix(frame, F.col("domain"), 300, weights, 2).collect()
        of = lambda level, name: getattr(weights, level).get(name, weights.default)  # noqa: E731, B023
        allowed = [r for r in rows if of("lang", r[2]) and of("source", r[3]) and of("domain", r[4])]
        tokens = sum(r[0] % 5 for r in rows)
        assert all(of("lang", r.lang) and of("source", r.source) and of("domain", r.domain) for r in got)
        if 2 * sum(r[0] % 5 for r in allowed) <= 3 * tokens:
            assert sorted((r.doc_id, r.copies) for r in got if r.n_tokens) == sorted((r[0], 2) for r in allowed if r[0] % 5)
    with pytest.raises(ValueError):
        M.Weights(lang={"en": -1})


def test_clashing_names_pass_through(spark):
    names = ["end", "whole", "buckets", "before", "remainder", "row", "_key", "_bucket", "_in", "_copy", "_domain", "tokens"]
    frame = spark.createDataFrame([(i, "a b", "en", "s") for i in range(9)], "doc_id long, text string, lang string, source string")
    plain = M.mix(frame, F.lit("d"), 150, WEIGHTS, 2)
    clashing = M.mix(frame.select("*", *[F.lit(n).alias(n) for n in names]), F.lit("d"), 150, WEIGHTS, 2)
    assert set(names) <= set(clashing.columns) and {tuple(r[n] for n in names) for r in clashing.collect()} == {tuple(names)}
    key = lambda f: sorted((r.doc_id, r.copies) for r in f.collect())
    assert key(clashing) == key(plain) and M.repeated(clashing).count() == sum(c for _, c in key(plain))
