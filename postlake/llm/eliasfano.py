"""Elias-Fano sequences and a two-level n-gram trie of them, in numpy.

A sorted sequence keeps the low bits of its values packed and the high bits in unary, with the
place of every 64th value. Levels are written to files and memory-mapped; a search decodes
only the chunks that its keys fall into.
"""

import os

import numpy as np

CHUNK = 64
SLAB = 1_024  # chunks decoded at a time
U = np.uint64


class EliasFano:
    """A non-decreasing sequence of whole numbers below 2**63."""

    def __init__(self, size: int, low_bits: int, low, high, places):
        self.size, self.low_bits = size, low_bits
        self.low, self.high, self.places = low, high, places

    @classmethod
    def build(cls, values: np.ndarray) -> "EliasFano":
        values = np.asarray(values, U)
        size = len(values)
        top = int(values[-1]) + 1 if size else 1
        low_bits = max(0, (top // max(size, 1)).bit_length() - 1)
        chunks = -(-size // CHUNK)
        padded = np.zeros(chunks * CHUNK, U)
        padded[:size] = values & U((1 << low_bits) - 1)
        padded = padded.reshape(-1, CHUNK)
        # 64 values of b bits fill b words.
        low = np.zeros((chunks, low_bits + 1), U)
        for j in range(CHUNK if low_bits else 0):
            word, bit = divmod(j * low_bits, 64)
            low[:, word] |= padded[:, j] << U(bit)
            if bit + low_bits > 64:
                low[:, word + 1] |= padded[:, j] >> U(64 - bit)
        ones = (values >> U(low_bits)).astype(np.int64) + np.arange(size)
        bits = np.zeros(int(ones[-1]) + 1 if size else 0, bool)
        bits[ones] = True
        return cls(size, low_bits, low, np.packbits(bits, bitorder="little"), ones[::CHUNK].copy())

    def decode(self, first: int, last: int) -> np.ndarray:
        """The values of chunks first to last (exclusive)."""
        begin, end = first * CHUNK, min(last * CHUNK, self.size)
        bit = int(self.places[first])
        stop = int(self.places[last]) if last < len(self.places) else len(self.high) * 8
        bits = np.unpackbits(np.asarray(self.high[bit // 8 : -(-stop // 8)]), bitorder="little")[bit % 8 :]
        ones = np.flatnonzero(bits)[: end - begin] + bit - np.arange(begin, end)
        low = np.asarray(self.low[first:last])
        out = np.zeros((last - first, CHUNK), U)
        mask = U((1 << self.low_bits) - 1)
        for j in range(CHUNK if self.low_bits else 0):
            word, shift = divmod(j * self.low_bits, 64)
            out[:, j] = low[:, word] >> U(shift)
            if shift + self.low_bits > 64:
                out[:, j] |= low[:, word + 1] << U(64 - shift)
        return (ones.astype(U) << U(self.low_bits)) | (out.ravel()[: end - begin] & mask)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Places of sorted keys in the sequence, -1 where absent."""
        out = np.full(len(keys), -1, np.int64)
        at = 0
        for first in range(0, len(self.places), SLAB):
            if at == len(keys):
                break
            last = min(first + SLAB, len(self.places))
            values = self.decode(first, last)
            end = np.searchsorted(keys, values[-1], side="right")
            if end > at:
                asked = keys[at:end]
                place = np.minimum(np.searchsorted(values, asked), len(values) - 1)
                out[at:end] = np.where(values[place] == asked, place + first * CHUNK, -1)
                at = end
        return out

    def take(self, places: np.ndarray) -> np.ndarray:
        """The values at sorted places."""
        out = np.zeros(len(places), U)
        at = 0
        while at < len(places):
            first = int(places[at]) // CHUNK
            last = min(first + SLAB, len(self.places))
            end = np.searchsorted(places, last * CHUNK)
            out[at:end] = self.decode(first, last)[places[at:end] - first * CHUNK]
            at = end
        return out

    def save(self, folder: str, name: str) -> None:
        for part in ("low", "high", "places"):
            np.save(os.path.join(folder, f"{name}.{part}.npy"), getattr(self, part))
        np.save(os.path.join(folder, f"{name}.head.npy"), np.array([self.size, self.low_bits]))

    @classmethod
    def load(cls, folder: str, name: str) -> "EliasFano":
        size, low_bits = np.load(os.path.join(folder, f"{name}.head.npy")).tolist()
        low, high, places = (
            np.load(os.path.join(folder, f"{name}.{part}.npy"), mmap_mode="r") if size else np.zeros((0, 1), U)
            for part in ("low", "high", "places")
        )
        return cls(size, low_bits, low, high, places)


class Trie:
    """Contexts and their successors. The successors of one context lie together, raised by
    the last value before them, so the level is one sorted sequence. A pointer says where each
    context's successors begin, and a successor is looked for relative to what precedes them.
    Each has a quantised probability."""

    @staticmethod
    def save(folder: str, contexts: np.ndarray, counts: np.ndarray, words: np.ndarray, codes: np.ndarray) -> None:
        """contexts: sorted ids; counts: how many successors each has, at least one; words:
        their ids, sorted in each context; codes: quantised probabilities."""
        ends = np.cumsum(counts)
        EliasFano.build(contexts).save(folder, "contexts")
        EliasFano.build(np.concatenate([[0], ends])).save(folder, "pointers")
        reach = np.cumsum(words[ends - 1].astype(U) + U(1)) if len(ends) else np.zeros(0, U)
        raised = words.astype(U) + np.repeat(np.concatenate([np.zeros(1, U), reach])[: len(ends)], counts)
        EliasFano.build(raised).save(folder, "successors")
        np.save(os.path.join(folder, "codes.npy"), codes)

    def __init__(self, folder: str):
        self.contexts = EliasFano.load(folder, "contexts")
        self.pointers = EliasFano.load(folder, "pointers")
        self.successors = EliasFano.load(folder, "successors")
        self.codes = np.load(os.path.join(folder, "codes.npy"), mmap_mode="r") if self.successors.size else np.zeros(0, np.uint16)

    def query(self, contexts: np.ndarray, counts: np.ndarray, words: np.ndarray, absent: int) -> np.ndarray:
        """Codes of the n-grams of sorted contexts, each with so many sorted words."""
        rank = self.contexts.find(np.asarray(contexts, U))
        known = rank >= 0
        begin = self.pointers.take(rank[known]).astype(np.int64)
        end = self.pointers.take(rank[known] + 1).astype(np.int64)
        base = np.zeros(len(begin), U)
        base[begin > 0] = self.successors.take(begin[begin > 0] - 1) + U(1)
        top = self.successors.take(end - 1)
        spread = np.zeros(len(contexts), np.int64)
        spread[known] = np.arange(len(begin))
        own = np.repeat(spread, counts)
        asked = np.repeat(known, counts)
        own = own[asked]
        keys = np.asarray(words, U)[asked] + base[own]
        inside = keys <= top[own]
        place = self.successors.find(keys[inside])
        found = np.full(len(place), absent, np.uint16)
        found[place >= 0] = self.codes[place[place >= 0]]
        within = np.full(len(keys), absent, np.uint16)
        within[inside] = found
        out = np.full(len(asked), absent, np.uint16)
        out[asked] = within
        return out
