"""Periodic runs of words by a dictionary of basic factors (Karp, Miller and Rosenberg, 1972).

A run is a stretch of consecutive words whose smallest period is q, of at least
max(MIN_LENGTH, MIN_PERIODS * q) words, that no neighbouring word extends with that period.

The dictionary names every stretch of 1, 2, 4, ... words, so that equal stretches have equal
names; a name of the next length is the pair of names of its halves. At length L the
occurrences of a name whose successors are at most 2L words away, in equal steps, form an
arithmetic progression and propose their step as a period; the names of length 2L at both ends
of a step say whether the words between agree too. A run of period q, L < q <= 2L, is always
proposed: if every stretch of L words recurred within a period there would be at most L
different ones, and by Morse and Hedlund's theorem the period would be at most L. The step is
the smallest period, as a smaller one would bring a nearer successor. Each progression is
extended word for word to both sides by comparing names of falling length (less than 2L words
are left on either side), and proposals of the same run are dropped.

Stretches that occur once cannot lie in a run and get no name, so after two or three lengths
little of ordinary prose is left; a wholly periodic text costs its words times the logarithm
of their number. Words are compared as bytes, not by hashes. Texts are worked
through in tasks, some megabytes at a time and each text whole; nothing is shuffled.

Edge cases: a null, empty or blank text has no words and no runs, and its collapsed text is
empty; rows that repeat an id are each done by themselves. Further columns pass through, and
those named like the results are replaced.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, types as T

from postlake.llm.words import text_chunks

MIN_LENGTH = 6
MIN_PERIODS = 4
RUNS = [
    T.StructField("n_words", T.LongType()),
    T.StructField("runs", T.ArrayType(T.StructType([T.StructField(c, T.LongType()) for c in ("start", "length", "period")]))),
    T.StructField("collapsed", T.StringType()),
]
RESULTS = [field.name for field in RUNS]


def _next_names(names: np.ndarray, step: int) -> np.ndarray:
    """Names of stretches twice as long as `step`; -1 where the stretch occurs once."""
    out = np.full(len(names), -1, np.int32)
    if len(names) <= step:
        return out
    at = np.flatnonzero((names[:-step] >= 0) & (names[step:] >= 0))
    pairs = names[at].astype(np.int64) * (int(names.max(initial=0)) + 1) + names[at + step]
    _, name, count = np.unique(pairs, return_inverse=True, return_counts=True)
    often = count >= 2
    again = (np.cumsum(often) - 1).astype(np.int32)
    live = often[name]
    out[at[live]] = again[name[live]]
    return out


def _progressions(names: np.ndarray, doubled: np.ndarray, most: int):
    """(first, last, step) of occurrences of one name in equal steps of at most `most`, over
    which the names of twice the length agree."""
    at = np.flatnonzero(names >= 0)
    at = at[np.argsort(names[at], kind="stable")]
    steps = np.where(names[at[1:]] == names[at[:-1]], at[1:] - at[:-1], 0)
    steps[(steps > most) | (doubled[at[1:]] < 0) | (doubled[at[1:]] != doubled[at[:-1]])] = 0
    # Stretches of equal steps.
    edge = np.flatnonzero(np.diff(steps, prepend=-1, append=-1))
    begin, end = edge[:-1], edge[1:]
    good = steps[begin] > 0
    return at[begin[good]], at[end[good]], steps[begin[good]]


def find_runs(names: np.ndarray) -> np.ndarray:
    """(start, length, period) of all runs, in order. Names are numbers of words; equal words
    of different texts have different names, and words met once have -1."""
    levels, found, length = [names], [], 1
    while (levels[-1] >= 0).any():
        doubled = _next_names(levels[-1], length)
        first, last, period = _progressions(levels[-1], doubled, 2 * length)
        # Shorter periods were proposed at shorter lengths.
        new = (period > length) | (length == 1)
        first, last, period = first[new], last[new], period[new]
        # Progressions that begin at neighbouring words with the same step are of the same run.
        order = np.lexsort((first, period))
        first, last, period = first[order], last[order], period[order]
        same = (np.diff(first, prepend=-2) == 1) & (np.diff(period, prepend=0) == 0)
        first, last, period = first[~same], last[~same], period[~same]
        start, end = first.copy(), last + 2 * length
        for k in reversed(range(len(levels))):
            size, level = 1 << k, levels[k]
            # To the right from `end`: the stretch there against that one period before.
            ok = end + size <= len(names)
            here = np.where(ok, end, period)
            equal = ok & (level[here] >= 0) & (level[here] == level[here - period])
            end = end + size * equal
            # To the left: the stretch before `start` against that one period later.
            ok = start >= size
            here = np.where(ok, start - size, 0)
            equal = ok & (level[here] >= 0) & (level[here] == level[np.minimum(here + period, len(names) - 1)])
            start = start - size * equal
        kept = end - start >= np.maximum(MIN_LENGTH, MIN_PERIODS * period)
        if kept.any():
            found.append(np.stack([start[kept], (end - start)[kept], period[kept]], axis=1))
        levels.append(doubled)
        length *= 2
    if not found:
        return np.zeros((0, 3), np.int64)
    # By start, then period; a run may have been proposed by several progressions.
    runs = np.unique(np.concatenate(found)[:, [0, 2, 1]], axis=0)
    return runs[:, [0, 2, 1]]


def text_runs(texts: list) -> list:
    """(words, runs, kept) of each text (bytes or None): runs as rows of start, length and
    period, kept as a mark for each word."""
    words, numbers = [], []
    for text in texts:
        own = (text or b"").split()
        table: dict = {}
        names = np.fromiter((table.setdefault(w, len(table)) for w in own), np.int64, len(own))
        words.append(own)
        often = np.bincount(names, minlength=len(table)) >= 2
        numbers.append(np.where(often[names], (np.cumsum(often) - 1)[names], -1) if len(own) else names)
    n_names = [int(x.max(initial=-1)) + 1 for x in numbers]
    offsets = np.cumsum([0, *n_names])
    joined = [np.where(x >= 0, x + offset, -1).astype(np.int32) for x, offset in zip(numbers, offsets)]
    runs = find_runs(np.concatenate([np.zeros(0, np.int32), *joined]))
    begins = np.cumsum([0, *(len(own) for own in words)])
    # A word is dropped if it lies in a run after that run's first period.
    marks = np.zeros(begins[-1] + 1, np.int64)
    np.add.at(marks, runs[:, 0] + runs[:, 2], 1)
    np.add.at(marks, runs[:, 0] + runs[:, 1], -1)
    kept = np.cumsum(marks)[:-1] == 0
    cuts = np.searchsorted(runs[:, 0], begins)
    return [
        (own, runs[low:high] - [begin, 0, 0], kept[begin : begin + len(own)])
        for own, begin, low, high in zip(words, begins, cuts, cuts[1:])
    ]


def _rows(column: str):
    def run(batches):
        for batch in batches:
            rest = [i for i, name in enumerate(batch.schema.names) if name not in RESULTS]
            for first, texts in text_chunks(batch, column):
                found = text_runs(texts)
                part = batch.slice(first, len(texts))
                sizes = np.cumsum([0, *(len(runs) for _, runs, _ in found)])
                flat = np.concatenate([np.zeros((0, 3), np.int64), *(runs for _, runs, _ in found)])
                structs = pa.StructArray.from_arrays(
                    [pa.array(flat[:, i]) for i in range(3)], names=["start", "length", "period"]
                )
                collapsed = [
                    b" ".join(own if kept.all() else [w for w, k in zip(own, kept.tolist()) if k]) for own, _, kept in found
                ]
                yield pa.RecordBatch.from_arrays(
                    [
                        *(part.column(i) for i in rest),
                        pa.array([len(own) for own, _, _ in found], pa.int64()),
                        pa.ListArray.from_arrays(pa.array(sizes, pa.int32()), structs),
                        pa.array(collapsed, pa.binary()).cast(pa.string()),
                    ],
                    names=[*(batch.schema.names[i] for i in rest), *RESULTS],
                )

    return run


def periodic_runs(docs: DataFrame, column: str = "text") -> DataFrame:
    """Every row with the number of its words, its runs by start and period, and the collapsed
    text: the words of which no run repeats an earlier one, joined by single spaces."""
    rest = [field for field in docs.schema if field.name not in RESULTS]
    return docs.mapInArrow(_rows(column), T.StructType([*rest, *RUNS]))
