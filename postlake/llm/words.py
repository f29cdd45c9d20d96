"""Words of whole texts as 64-bit hashes, in numpy, for code that runs inside tasks.

A word is a run of bytes other than space and 0x09 to 0x0D; A-Z are lower-cased. Texts are
worked through in pieces of some megabytes, so memory does not depend on one long text.
"""

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

PIECE_BYTES = 2_000_000
LOWER = bytes(range(256)).lower()
U = np.uint64
STEP = U(0x9E3779B97F4A7C15)
ODD = U(0xD6E8FEB86659FD93)
GAPS = np.isin(np.arange(256), [0x09, 0x0A, 0x0B, 0x0C, 0x0D, 0x20])


def mix(h: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit numbers."""
    h = (h ^ (h >> U(32))) * ODD
    h = (h ^ (h >> U(32))) * ODD
    return h ^ (h >> U(32))


BYTE_VALUES = mix(np.arange(1, 257, dtype=U))


def _powers(n: int) -> np.ndarray:
    steps = np.full(n, STEP)
    steps[0] = 1
    return np.multiply.accumulate(steps)


def _piece(buf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash, start) of each word of a piece."""
    inside = ~GAPS[buf]
    edges = np.flatnonzero(np.diff(inside.astype(np.int8), prepend=0, append=0))
    starts, lengths = edges[::2], edges[1::2] - edges[::2]
    if not len(starts):
        return np.zeros(0, U), starts
    at = np.flatnonzero(inside)
    places = at - np.repeat(starts, lengths)
    values = BYTE_VALUES[buf[at]] * _powers(int(lengths.max()))[places]
    first = np.cumsum(lengths) - lengths
    return mix(np.add.reduceat(values, first) + lengths.astype(U)), starts


def word_hashes(texts: list) -> tuple[np.ndarray, np.ndarray]:
    """(hashes of all words, where each text's words begin, with an end): texts are bytes or None."""
    raw = [text or b"" for text in texts]
    buf = np.frombuffer(b"\n".join([*raw, b""]).translate(LOWER), np.uint8)
    hashes, starts, at = [], [], 0
    while at < len(buf):
        end = min(at + PIECE_BYTES, len(buf))
        while end < len(buf) and not GAPS[buf[end - 1]]:
            ahead = GAPS[buf[end : end + PIECE_BYTES]]
            end += int(ahead.argmax()) + 1 if ahead.any() else len(ahead)
        found, where = _piece(buf[at:end])
        hashes.append(found)
        starts.append(where + at)
        at = end
    hashes = np.concatenate([np.zeros(0, U), *hashes])
    begins = np.cumsum([0, *(len(text) + 1 for text in raw)])
    return hashes, np.searchsorted(np.concatenate([np.zeros(0, np.int64), *starts]), begins)


def shingle_sets(texts: list, k: int) -> list[np.ndarray]:
    """Each text's sorted distinct k-word shingles; the whole sequence if it has fewer words."""
    hashes, begins = word_hashes(texts)
    rolled = hashes[: max(0, len(hashes) - k + 1)]
    for i in range(1, k):
        rolled = mix(rolled * STEP + hashes[i : len(rolled) + i])
    out = []
    for begin, end in zip(begins[:-1], begins[1:]):
        if end - begin >= k:
            out.append(np.unique(rolled[begin : end - k + 1]))
        elif end > begin:
            short = hashes[begin:end]
            whole = mix(np.array([end - begin], U))
            for h in short:
                whole = mix(whole * STEP + h)
            out.append(whole)
        else:
            out.append(np.zeros(0, U))
    return out


def text_chunks(batch: pa.RecordBatch, column: str, most=4_000_000):
    """(first row, texts as bytes or None) of an Arrow batch, some megabytes of text at a time."""
    texts = batch.column(batch.schema.get_field_index(column)).cast(pa.large_binary())
    sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
    begin, size = 0, 0
    for i, more in enumerate(sizes.tolist()):
        size += more
        if size >= most or i + 1 == len(sizes):
            yield begin, texts.slice(begin, i + 1 - begin).to_pylist()
            begin, size = i + 1, 0
