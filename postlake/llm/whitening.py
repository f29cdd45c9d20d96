"""Whitening of vectors along the leading components of their covariance.

Entries become whole numbers x = floor(256 c). The fit goes over each distinct x once: every
task reduces its rows, centred on their own mean, to a triangle R by QR in blocks; triangles of
tasks meet in rounds of a fixed fan-in, with one row more for the difference of the means, so
that R'R ends as the scatter about the mean of all. The last triangle is solved as
`bidiagonal.py` says. Then a second pass over the fit list sums the covariance of the whitened
vectors, and a third whitens every row.

Sums of x are whole numbers, kept as two 64-bit parts. What a task holds and what meets in one
task are triangles, whose size depends on the width of the vectors and not on their number.
Vectors of different width are tables of their own; widths are fitted in any number and used
WIDTHS at a time, so tasks get a bounded number of fits, and each further WIDTHS widths cost
another reading of the rows.

Edge cases: rows whose vector is null or holds a null or non-finite entry, and vectors without
entries, go; a null id stays. Entries are held within 2^53, beyond which doubles are not whole
numbers apart. Components of zero variance (constant vectors, fewer distinct vectors than
components) have a null whitened value and explain 0; a vector narrower than `k` has as many
components as entries. A deviation beyond 64 bits is null. Repeated rows count once in the fit
and are returned each. Further columns are ignored. An empty table gives an empty result.
"""

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from postlake.llm.arrays import by_width
from postlake.llm.bidiagonal import leading_components
from postlake.session import stage

COMPONENTS = 4
GRID = 256
BOUND = float(1 << 53)
#: Rows of a QR step, bytes of triangles that a task holds or merges at once, widths used at once.
ROWS = 4_096
TRIANGLE_BYTES = 64_000_000
WIDTHS = 64
LOW_BITS = 26
PART = "width int, block bigint, n bigint, high binary, low binary, r binary"
FIT = "width int, n bigint, high binary, low binary, components binary, variances binary, trace double"


class Scatter:
    """Number, exact sums and triangle of some vectors of one width."""

    def __init__(self, n, high, low, r):
        self.n, self.high, self.low, self.r = n, high, low, r

    @classmethod
    def of(cls, x: np.ndarray):
        rows = x.astype(np.float64)
        return cls(len(x), (x >> LOW_BITS).sum(axis=0), (x & ((1 << LOW_BITS) - 1)).sum(axis=0), np.linalg.qr(rows - rows.mean(axis=0), "r"))

    def mean(self) -> np.ndarray:
        return (self.high * float(1 << LOW_BITS) + self.low) / self.n

    @classmethod
    def merged(cls, parts: list):
        """One triangle of several: theirs and a weighted row for each mean's distance."""
        n, high, low = (sum(getattr(p, x) for p in parts) for x in ("n", "high", "low"))
        mean = (high * float(1 << LOW_BITS) + low) / n
        means = np.stack([np.sqrt(p.n) * (p.mean() - mean) for p in parts])
        return cls(n, high, low, np.linalg.qr(np.concatenate([*(p.r for p in parts), means]), "r"))


def _reduce(batches):
    held: dict = {}
    block = TaskContext.get().partitionId()

    def rows():
        fields = [(width, block, s.n, s.high.tobytes(), s.low.tobytes(), s.r.tobytes()) for width, s in held.items()]
        held.clear()
        return pa.RecordBatch.from_pylist([dict(zip(("width", "block", "n", "high", "low", "r"), f)) for f in fields], schema=pa.schema([
            ("width", pa.int32()), ("block", pa.int64()), ("n", pa.int64()), ("high", pa.binary()), ("low", pa.binary()), ("r", pa.binary()),
        ]))

    for batch in batches:
        for width, _, x in by_width(batch, "x"):
            for at in range(0, len(x), ROWS):
                own = Scatter.of(x[at : at + ROWS])
                held[width] = Scatter.merged([held[width], own]) if width in held else own
            if sum(8 * w * w for w in held) > TRIANGLE_BYTES:
                yield rows()
    if held:
        yield rows()


def _read(part: pd.DataFrame) -> list:
    width = int(part["width"].iloc[0])
    return [
        Scatter(int(n), np.frombuffer(high, np.int64), np.frombuffer(low, np.int64), np.frombuffer(r, np.float64).reshape(-1, width))
        for n, high, low, r in zip(part["n"], part["high"], part["low"], part["r"])
    ]


def _merge(part: pd.DataFrame) -> pd.DataFrame:
    s = Scatter.merged(_read(part))
    return pd.DataFrame([{
        "width": part["width"].iloc[0], "block": part["block"].iloc[0], "n": s.n,
        "high": s.high.tobytes(), "low": s.low.tobytes(), "r": s.r.tobytes(),
    }])


def _solve(k: int):
    def run(part: pd.DataFrame) -> pd.DataFrame:
        s, width = Scatter.merged(_read(part)), int(part["width"].iloc[0])
        square = np.zeros((width, width))
        square[: len(s.r)] = s.r
        values, components = leading_components(square, k)
        return pd.DataFrame([{
            "width": width, "n": s.n, "high": s.high.tobytes(), "low": s.low.tobytes(), "components": components.tobytes(),
            "variances": (values[:k] / s.n).tobytes(), "trace": float(values.sum() / s.n),
        }])

    return run


def grid(embedding) -> F.Column:
    """x of each entry."""
    whole = lambda c: F.floor(F.least(F.greatest(c.cast("double") * GRID, F.lit(-BOUND)), F.lit(BOUND)))
    return F.transform(embedding, whole)


def finite(embedding) -> F.Column:
    """Whether there are entries, all of them finite numbers."""
    good = lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != F.lit(float("inf")))
    return F.coalesce((F.size(embedding) > 0) & F.forall(embedding, good), F.lit(False))


def fit(distinct: DataFrame, k: int) -> DataFrame:
    """FIT rows, one per width, of distinct vectors `x`."""
    parts = stage(distinct.select("x").mapInArrow(_reduce, PART), "triangles")
    most = parts.agg(F.max("block"), F.max("width")).first()
    blocks, fan = (most[0] or 0) + 1, max(2, TRIANGLE_BYTES // max(1, 8 * (most[1] or 1) ** 2))
    while blocks > fan:
        parts = stage(
            parts.withColumn("block", F.floor(F.col("block") / fan)).groupBy("width", "block").applyInPandas(_merge, PART), "triangles"
        )
        blocks = -(-blocks // fan)
    return parts.groupBy("width").applyInPandas(_solve(k), FIT)


class Fit:
    """A row of FIT as arrays."""

    def __init__(self, row):
        self.n, self.trace, self.error = row.n, row.trace, 0.0
        high, low = np.frombuffer(row.high, np.int64), np.frombuffer(row.low, np.int64)
        self.sums = [(int(h) << LOW_BITS) + int(x) for h, x in zip(high, low)]
        self.mean = np.array([s / row.n for s in self.sums])
        self.components = np.frombuffer(row.components).reshape(-1, row.width)
        self.variances = np.frombuffer(row.variances)

    def whitened(self, x: np.ndarray) -> np.ndarray:
        """NaN where a component has no variance."""
        with np.errstate(invalid="ignore", divide="ignore"):
            return (x - self.mean) @ self.components.T / np.where(self.variances > 0, np.sqrt(self.variances), np.nan)

    def deviation(self, x: np.ndarray) -> list:
        """sum of (n x - S)^2, exactly; None beyond 64 bits."""
        most = self.n * int(np.abs(x).max(initial=0)) + max(map(abs, self.sums))
        if most * most * len(self.sums) < 1 << 63:
            return ((self.n * x - np.array(self.sums, np.int64)) ** 2).sum(axis=1).tolist()
        exact = ((self.n * x.astype(object) - np.array(self.sums, object)) ** 2).sum(axis=1).tolist()
        return [d if d < 1 << 63 else None for d in exact]


def _moments(fits: dict):
    """Sums of the whitened vectors and of their products, per task."""

    def run(batches):
        total: dict = {}
        for batch in batches:
            for width, _, x in by_width(batch, "x"):
                w = fits[width].whitened(x)
                own = np.concatenate([w.sum(axis=0), (w.T @ w).ravel()])
                total[width] = total.get(width, 0) + own
        for width, sums in total.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([width] * len(sums), pa.int32()), pa.array(np.arange(len(sums)), pa.int32()), pa.array(sums, pa.float64())],
                names=["width", "at", "value"],
            )

    return run


def _errors(distinct: DataFrame, fits: dict) -> None:
    """Sets the largest entry of the whitened covariance minus the identity."""
    sums = distinct.mapInArrow(_moments(fits), "width int, at int, value double").groupBy("width", "at").agg(F.sum("value").alias("value"))
    found: dict = {}
    for row in sums.collect():
        found.setdefault(row.width, {})[row.at] = row.value
    for width, values in found.items():
        fit, k = fits[width], len(fits[width].variances)
        flat = np.array([values[i] for i in range(k + k * k)])
        mean = flat[:k] / fit.n
        gap = np.abs(flat[k:].reshape(k, k) / fit.n - np.outer(mean, mean) - np.eye(k))
        fit.error = float(gap[np.ix_(fit.variances > 0, fit.variances > 0)].max(initial=0.0))


WHITENED = "vec_id bigint, n bigint, deviation bigint, whitened array<double>, explained array<double>, identity_error double"


def _whiten(fits: dict):
    def run(batches):
        for batch in batches:
            for width, places, x in by_width(batch, "x"):
                fit = fits[width]
                flat, k = fit.whitened(x).ravel(), len(fit.variances)
                ends = pa.array(np.arange(len(x) + 1) * k, pa.int32())
                share = fit.variances / fit.trace if fit.trace else np.zeros(k)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(pa.array(places)), pa.array([fit.n] * len(x), pa.int64()), pa.array(fit.deviation(x), pa.int64()),
                        pa.ListArray.from_arrays(ends, pa.array(flat, pa.float64(), mask=np.isnan(flat))),
                        pa.ListArray.from_arrays(ends, pa.array(np.tile(share, len(x)), pa.float64())),
                        pa.array([fit.error] * len(x), pa.float64()),
                    ],
                    names=["vec_id", "n", "deviation", "whitened", "explained", "identity_error"],
                )

    return run


def whiten(vectors: DataFrame, k: int = COMPONENTS) -> DataFrame:
    """(vec_id, n, deviation, whitened, explained, identity_error) per usable row of vectors
    (vec_id, embedding): arrays hold the first k components by falling variance."""
    rows = vectors.where(finite(F.col("embedding"))).select(F.col("vec_id").cast("bigint"), grid(F.col("embedding")).alias("x"))
    distinct = stage(rows.select("x").distinct(), "fit-list")
    found = stage(fit(distinct, k), "fits")
    widths = [r.width for r in found.select("width").orderBy("width").collect()]
    out = vectors.sparkSession.createDataFrame([], WHITENED)
    for at in range(0, len(widths), WIDTHS):
        some = F.col("width").between(widths[at], widths[min(at + WIDTHS, len(widths)) - 1])
        fits = {r.width: Fit(r) for r in found.where(some).collect()}
        own = lambda frame: frame.where(F.size("x").between(min(fits), max(fits)))  # noqa: E731, B023
        _errors(own(distinct), fits)
        part = own(rows).mapInArrow(_whiten(fits), WHITENED)
        out = part if at == 0 else out.union(part)
    return out
