from collections import Counter, defaultdict

import numpy as np
import pytest
from samples import HARD, PROSE

from postlake.llm import setjoin as S


def sets_of(rows, k):
    out = []
    for _, text in rows:
        words = (text or "").encode().lower().split()
        out.append({tuple(words[i : i + k]) for i in range(len(words) - k + 1)} if len(words) >= k else ({tuple(words)} if words else set()))
    return out


def brute(rows, k, percent):
    """Per row (n_shingles, component by doc_id, links)."""
    sets = sets_of(rows, k)
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    links = Counter()
    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if (rows[i][0] is None or rows[j][0] is None) and sets[i] != sets[j]:
                continue
            if both and 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                links[i] += 1
                links[j] += 1
                parent[root(i)] = root(j)
    members = defaultdict(list)
    for i in range(len(rows)):
        members[root(i)].append(rows[i][0])
    least = {r: min([x for x in ids if x is not None], default=None) for r, ids in members.items()}
    return sorted(
        [(rows[i][0], len(sets[i]), least[root(i)] if rows[i][0] is not None else None, links[i]) for i in range(len(rows))], key=repr
    )


@pytest.mark.parametrize("k, percent", [(4, 85), (5, 80)])
def test_hard_rows(spark, hard, k, percent):
    got = sorted((tuple(r) for r in S.jaccard_components(hard, k, percent).collect()), key=repr)
    assert got == brute([(r[0], r[1]) for r in HARD], k, percent)


def test_threshold_is_exact(spark):
    base = [f"u{i}" for i in range(103)]  # 100 shingles of 4
    rows = [(1, " ".join(base)), (2, " ".join([*base[:-8], *[f"x{i}" for i in range(8)]])),
            (3, " ".join([*base, *[f"y{i}" for i in range(17)]])), (4, " ".join([*base, *[f"z{i}" for i in range(18)]]))]
    got = {r.doc_id: r.component_id for r in S.jaccard_components(spark.createDataFrame(rows, "doc_id long, text string"), 4, 85).collect()}
    want = {r[0]: r[2] for r in brute(rows, 4, 85)}
    assert got == want and got[2] == 1


def test_large_group_is_cut_into_blocks(spark, monkeypatch):
    """Near copies of one text, none like another by chance, in many small units."""
    monkeypatch.setattr(S, "UNIT_SHINGLES", 400)
    monkeypatch.setattr(S, "LONG_LIST", 3)
    rng = np.random.default_rng(5)
    words = PROSE.split()
    rows = []
    for i in range(60):
        text = list(words)
        for at in rng.choice(len(text), size=int(rng.integers(0, 3)), replace=False):
            text[at] = f"n{i}x{at}"
        rows.append((i, " ".join(text)))
    got = sorted((tuple(r) for r in S.jaccard_components(spark.createDataFrame(rows, "doc_id long, text string"), 4, 85).collect()), key=repr)
    assert got == brute(rows, 4, 85)


def test_divide_skip_equals_counting():
    rng = np.random.default_rng(3)
    base = np.sort(rng.choice(10_000, 200, replace=False)).astype(np.uint64)
    sets = []
    for _ in range(80):
        keep = base[rng.random(200) > rng.choice([0.02, 0.08, 0.3])]
        sets.append(np.unique(np.concatenate([keep, rng.choice(10_000, int(rng.integers(0, 20))).astype(np.uint64)])))
    found = {(min(i, j), max(i, j), n) for i, js, ns in S.divide_skip(sets, np.zeros(80, int), 85) for j, n in zip(js, ns)}
    want = set()
    for i in range(80):
        for j in range(i):
            n = len(np.intersect1d(sets[i], sets[j]))
            if 100 * n >= 85 * (len(sets[i]) + len(sets[j]) - n):
                want.add((j, i, n))
    assert found == want and want


def test_empty_and_removal(spark, empty, hard):
    assert S.jaccard_components(empty).count() == 0
    assert S.near_duplicates_removed(empty).count() == 0
    left = sorted((r.doc_id for r in S.near_duplicates_removed(hard).collect()), key=repr)
    # 2 and 3 repeat 1; 9 repeats 8; the null id stays.
    assert left == sorted([1, 1, 4, 5, 6, 7, 8, 10, 11, 12, 13, None, None], key=repr)


def test_an_id_with_several_texts(spark):
    """Each text of an id has its own links; two of them may link with each other only."""
    other, third = " ".join(PROSE.split()[::-1]), " ".join(sorted(PROSE.split()))
    rows = [(5, PROSE), (5, other), (9, other + " end"), (4, PROSE + " end"), (5, PROSE),
            (7, third), (7, third + " end"), (8, " ".join(sorted(PROSE.split(), key=lambda w: w[::-1])))]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((r.doc_id, r.n_shingles, r.component_id, r.n_links) for r in S.jaccard_components(frame, 4, 85).collect())
    # Links as by brute force; 4 and 9 are joined by their links with texts of 5.
    want = sorted((i, n, 4 if i in (4, 5, 9) else c, links) for i, n, c, links in brute(rows, 4, 85))
    assert got == want and [r[3] for r in got if r[0] in (7, 9)] == [1, 1, 1]
    assert {r.doc_id for r in S.near_duplicates_removed(frame, 4, 85).collect()} == {4, 7, 8}


def test_a_part_without_sets(spark, monkeypatch):
    """Few long sets cut into many parts, some of which are empty."""
    monkeypatch.setattr(S, "UNIT_SHINGLES", 20)
    rows = [(3 * group + i, " ".join([f"{w}{group}" for w in PROSE.split()] + ["end"] * (i + 1))) for group in range(16) for i in range(3)]
    got = sorted((tuple(r) for r in S.jaccard_components(spark.createDataFrame(rows, "doc_id long, text string"), 4, 85).collect()), key=repr)
    assert got == brute(rows, 4, 85)


def test_null_id_beside_large_ids(spark):
    """Ids that floating point cannot hold, in one block with a null id."""
    rows = [(2**60 + 1, PROSE), (None, PROSE[::-1]), (2**60 + 3, PROSE + " end"), (-(2**62) - 1, PROSE + " the end"), (2**63 - 1, "one")]
    frame = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    got = sorted((tuple(r) for r in S.jaccard_components(frame, 4, 85).collect()), key=repr)
    assert got == brute(rows, 4, 85) and sum(r[3] for r in got) == 6
