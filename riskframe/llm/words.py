"""Words of many texts at once: positions and 64-bit hashes by NumPy over Arrow buffers.

A word is a run of bytes other than the six ASCII spaces (0x20, 0x09-0x0D). Its hash is the
sum of random byte values times random weights of their places in the word modulo 2**64,
taken from prefix sums, then mixed; a window's hash joins the hashes of its parts, of
doubling length, and mixes after each. (A polynomial modulo 2**64 would give equal hashes
to some different words, whatever its base.) Hashes depend on the words alone, so they
agree between tasks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SPACE = np.zeros(256, bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
BYTE_VALUES = np.random.default_rng(20240607).integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
STEP = np.uint64(0x9E3779B97F4A7C15)
#: Bytes of text handled at once; temporary arrays take about thirty times as much.
PIECE_BYTES = 1 << 20

_weights = np.empty(0, np.uint64)


def weights(n: int) -> np.ndarray:
    """Random odd weights of places 0 to n - 1, the same in every task; kept and extended as needed."""
    global _weights
    if len(_weights) < n:
        _weights = mix(np.arange(1, max(n, 2 * len(_weights)) + 1, dtype=np.uint64) * STEP) | np.uint64(1)
    return _weights[:n]


def mix(h: np.ndarray) -> np.ndarray:
    """Finalizer that spreads every input bit over all output bits."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def join(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Hash of two hashes in order."""
    return mix(a * STEP + mix(b + STEP))


class Words:
    """Words of the texts ``data[ends[i-1]:ends[i]]``.

    starts, stops: byte positions; doc: index of each word's text; first: index of each
    text's first word (one more at the end); hash: one per word.
    """

    def __init__(self, data: np.ndarray, offsets: np.ndarray, lower: bool = False, breaks=None, space=SPACE):
        n = len(data)
        self.offsets = offsets = np.asarray(offsets, np.int64)
        self.data = data = LOWER[data] if lower else data
        inside = ~space[data]
        begin = np.empty(n + 1, bool)
        begin[0] = begin[n] = True
        np.logical_not(inside[:-1], out=begin[1:n])
        begin[offsets] = True
        if breaks is not None:
            begin[1:n] |= breaks(data)
        self.starts = np.flatnonzero(begin[:n] & inside)
        stop = begin[1:] | np.append(~inside[1:], True)
        self.stops = np.flatnonzero(stop & inside) + 1
        self.first = np.searchsorted(self.starts, offsets)
        counts = np.diff(self.first)
        self.doc = np.repeat(np.arange(len(counts)), counts)
        place = np.zeros(n, np.int64)
        place[self.starts] = self.starts
        place = np.arange(n) - np.maximum.accumulate(place)
        self._sums = np.zeros(n + 1, np.uint64)
        np.cumsum(BYTE_VALUES[data] * weights(int(place.max(initial=0)) + 1)[place], out=self._sums[1:])
        self.hash = self.hash_between(self.starts, self.stops)

    def __len__(self) -> int:
        return len(self.starts)

    def hash_between(self, starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
        """Hash of bytes [start, stop), each of which starts a word and stays in it."""
        return mix(self._sums[stops] - self._sums[starts] + (stops - starts).astype(np.uint64) * STEP)

    def word(self, i: int) -> bytes:
        return self.data[self.starts[i] : self.stops[i]].tobytes()

    def windows(self, k: int, hashes: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """First word and hash of each run of k words inside one text."""
        h = self.hash if hashes is None else hashes
        n = len(h)
        if n < k:
            return np.empty(0, np.int64), np.empty(0, np.uint64)
        # `block` hashes runs of 1, 2, 4, ... words, `done` the first words of each window.
        block, size, done, covered = h, 1, None, 0
        while covered < k:
            if k & size:
                done = block if done is None else join(done[: n - covered - size + 1], block[covered:])
                covered += size
            if covered < k:
                block = join(block[:-size], block[size:])
                size *= 2
        at = np.flatnonzero(self.doc[: n - k + 1] == self.doc[k - 1 :])
        return at, done[at]


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets (one more than rows) of a string or binary column; NULL is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("" if pa.types.is_string(column.type) or pa.types.is_large_string(column.type) else b"")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    kind = np.int64 if wide else np.int32
    if offsets is None or len(column) == 0:
        return np.empty(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    at = np.frombuffer(offsets, kind, len(column) + 1, column.offset * np.dtype(kind).itemsize).astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return raw[at[0] : at[-1]], at - at[0]


def pieces(offsets: np.ndarray, limit: int = PIECE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``limit`` bytes; a longer text is a range of its own."""
    n, at = len(offsets) - 1, 0
    while at < n:
        end = int(np.searchsorted(offsets, offsets[at] + limit, side="right")) - 1
        end = min(max(end, at + 1), n)
        yield at, end
        at = end


def word_batches(batch: pa.RecordBatch, column: str = "text", **how) -> Iterator[tuple[int, int, Words]]:
    """Row range and words of each piece of an Arrow batch."""
    data, offsets = text_buffer(batch.column(batch.schema.get_field_index(column)))
    for a, b in pieces(offsets):
        yield a, b, Words(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], **how)


def ranges(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """starts[0], starts[0]+1, ... counts[0] of them, then the next."""
    total = int(counts.sum())
    if not total:
        return np.empty(0, np.int64)
    ends = np.cumsum(counts)
    return np.arange(total) + np.repeat(starts - (ends - counts), counts)
