"""Substring dedup: word windows that occur again, found by level-wise doubling.

Windows of a short length are counted first. Only windows repeated at one length are
extended to twice that length, until the wanted length is reached (or, without one, until
no candidate survives). Texts are packed into blocks once. Per level, a block sends each
distinct window hash once, as one binary value per hash range; the range's task tells which
hashes occur twice, and answers with one bit each. So a window with very many copies is one
hash per block, rows never pair up, and what is shuffled is a few bytes per window.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.llm.common import small_batches, stage, text_of
from riskframe.llm.words import Words, mix, pieces, text_buffer

BLOCK_BYTES = 2 << 20
#: Text of a block whose words are found at once; that takes about fifty times as much.
PIECE_BYTES = 1 << 17
#: Blocks are large rows: pages and row groups of their files are measured after each row, not after a hundred.
BLOCK_FILES = {
    "parquet.block.size": 16 << 20, "parquet.block.size.row.check.min": 1, "parquet.page.size.row.check.min": 1,
    "parquet.enable.dictionary": "false",
}
#: Windows that one range task handles, about; ranges grow in number with the words.
RANGE_WINDOWS = 2_000_000
LEAST_RANGES = 64
#: Bytes of a hash sent beyond its range. A wrong hit needs equal bytes in one range at every level.
SHORT, FULL = 6, 8

#: A range's hashes are compared in so many shares, by their last byte.
SHARES = 8

BLOCKS = "block long, n_words long, doc_id array<long>, size array<int>, data binary"


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    part, made = TaskContext.get().partitionId(), 0
    ids: list = []
    sizes: list[int] = []
    data: list[bytes] = []
    total = 0

    def block():
        joined = b"".join(data)
        columns = [[(part << 32) + made], [len(_BlockWords(joined, sizes))], [ids], [sizes], [joined]]
        types = [pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.binary()]
        names = ["block", "n_words", "doc_id", "size", "data"]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names)

    for batch in batches:
        raw, offsets = text_buffer(batch.column(1))
        for i, doc_id in enumerate(batch.column(0).to_pylist()):
            text = raw[offsets[i] : offsets[i + 1]].tobytes()
            if data and total + len(text) > BLOCK_BYTES:
                yield block()
                made, ids, sizes, data, total = made + 1, [], [], [], 0
            ids.append(doc_id)
            sizes.append(len(text))
            data.append(text)
            total += len(text)
    if data:
        yield block()


def pack_blocks(docs: DataFrame) -> DataFrame:
    """Texts packed into staged blocks of about ``BLOCK_BYTES``, one row each; no shuffle."""
    small_batches(docs.sparkSession)
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    return stage(source.mapInArrow(_pack, BLOCKS), options=BLOCK_FILES)


class _BlockWords(Words):
    """Of the words of a block only hash, doc and first, found in pieces."""

    def __init__(self, data: bytes, sizes: list[int]):
        raw, offsets = np.frombuffer(data, np.uint8), np.append(0, np.cumsum(sizes, dtype=np.int64))
        found, counts = [], [np.zeros(1, np.int64)]
        for a, b in pieces(offsets, PIECE_BYTES):
            part = Words(raw[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
            found.append(part.hash)
            counts.append(np.diff(part.first))
        self.hash = np.concatenate(found) if found else np.empty(0, np.uint64)
        counts = np.concatenate(counts)
        self.first = np.cumsum(counts)
        self.doc = np.repeat(np.arange(len(counts) - 1), counts[1:])

    def __len__(self) -> int:
        return len(self.hash)


def _words(row: dict) -> _BlockWords:
    return _BlockWords(row["data"], row["size"])


def _range_of(hashes: np.ndarray, n: int) -> np.ndarray:
    return ((hashes >> np.uint64(32)) * np.uint64(n)) >> np.uint64(32)


class _Level:
    """Candidates of one level in one block: where they start, and their distinct hashes."""

    def __init__(self, words: Words, length: int, alive: np.ndarray | None, before: int, n_ranges: int):
        at, h = words.windows(length)
        if alive is not None:
            keep = alive[at] & alive[at + length - before]
            at, h = at[keep], h[keep]
        self.at = at
        self.distinct, self.back, counts = np.unique(mix(h ^ np.uint64(length)), return_inverse=True, return_counts=True)
        self.again = counts > 1
        self.cuts = np.searchsorted(_range_of(self.distinct, n_ranges), np.arange(n_ranges + 1))

    def repeated(self, n_words: int, answers: dict[int, bytes]) -> np.ndarray:
        """Whether the window at each word occurs again."""
        hit = np.zeros(len(self.distinct), bool)
        for r, bits in answers.items():
            a, b = self.cuts[r], self.cuts[r + 1]
            hit[a:b] = np.unpackbits(np.frombuffer(bits, np.uint8), count=b - a).astype(bool)
        alive = np.zeros(n_words, bool)
        alive[self.at[hit[self.back]]] = True
        return alive


def _replay(words: Words, lengths: list[int], answers: list[dict[int, bytes]], n_ranges: int):
    """Survivors after each answered level, from the last one on: (alive, length)."""
    alive, before = None, 0
    for length, said in zip(lengths, answers):
        alive = _Level(words, length, alive, before, n_ranges).repeated(len(words), said)
        before = length
    return alive, before


def _answers(rows: pa.Table | None, levels: int) -> list[dict[int, bytes]]:
    out: list[dict[int, bytes]] = [{} for _ in range(levels)]
    for row in rows.to_pylist() if rows is not None else []:
        out[row["level"]][row["range"]] = row["bits"]
    return out


SENT = "range long, block long, hashes binary, again binary"


def _send(level: _Level, block: int, width: int) -> Iterator[dict]:
    for r in np.flatnonzero(np.diff(level.cuts)):
        a, b = level.cuts[r], level.cuts[r + 1]
        part = np.ascontiguousarray(level.distinct[a:b].view(np.uint8).reshape(-1, 8)[:, :width])
        yield {"range": int(r), "block": block, "hashes": part.tobytes(), "again": np.packbits(level.again[a:b]).tobytes()}


SENT_TYPE = pa.schema([("range", pa.int64()), ("block", pa.int64()), ("hashes", pa.binary()), ("again", pa.binary())])


def _decide(level: int, width: int) -> Callable:
    def run(rows: pa.Table) -> pa.Table:
        blocks, which = rows.column("block").to_pylist(), rows.column("range")[0].as_py()
        sizes = [n // width for n in pc.binary_length(rows.column("hashes")).to_pylist()]
        ends = np.cumsum(sizes)
        wide, hit = np.zeros((ends[-1], 8), np.uint8), np.empty(ends[-1], bool)
        for hashes, again, n, e in zip(rows.column("hashes"), rows.column("again"), sizes, ends):
            wide[e - n : e, :width] = np.frombuffer(hashes.as_buffer(), np.uint8).reshape(-1, width)
            hit[e - n : e] = np.unpackbits(np.frombuffer(again.as_buffer(), np.uint8), count=n)
        key = wide.view("<u8").ravel()
        for share in range(SHARES):
            at = np.flatnonzero(wide[:, 0] % SHARES == share)
            at = at[np.argsort(key[at])]
            same = key[at[1:]] == key[at[:-1]]
            hit[at[:-1][same]] = True
            hit[at[1:][same]] = True
        out = [(b, which, np.packbits(hit[e - n : e]).tobytes()) for b, n, e in zip(blocks, sizes, ends) if hit[e - n : e].any()]
        return pa.table({
            "block": pa.array([x[0] for x in out], pa.int64()), "level": pa.array([level] * len(out), pa.int64()),
            "range": pa.array([x[1] for x in out], pa.int64()), "bits": pa.array([x[2] for x in out], pa.binary()),
        })

    return run


ANSWER = "block long, level long, range long, bits binary"


def _first(length: int, width: int, n_ranges: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in (x for batch in batches for i in range(batch.num_rows) for x in batch.slice(i, 1).to_pylist()):
            level = _Level(_words(row), length, None, 0, n_ranges)
            yield pa.RecordBatch.from_pylist(list(_send(level, row["block"], width)), SENT_TYPE)

    return run


def _further(lengths: list[int], width: int, n_ranges: int) -> Callable:
    def run(block: pa.Table, said: pa.Table) -> pa.Table:
        out: list[dict] = []
        for row in block.to_pylist() if len(said) else []:
            words = _words(row)
            alive, before = _replay(words, lengths[:-1], _answers(said, len(lengths) - 1), n_ranges)
            out += _send(_Level(words, lengths[-1], alive, before, n_ranges), row["block"], width)
        return pa.Table.from_pylist(out, SENT_TYPE)

    return run


def doubled(start: int, until: int | None) -> Iterator[int]:
    length = start
    while until is None or length < until:
        yield length
        length *= 2
    yield until


def repeated_windows(blocks: DataFrame, start: int, until: int | None) -> tuple[list[int], DataFrame | None, int]:
    """Levels run, the staged answers of all of them, and the number of hash ranges.

    ``until=None`` doubles until no window survives; the last level in the answers is then
    the greatest of the doubled lengths at which any window occurs again.
    """
    spark = blocks.sparkSession
    total = blocks.agg(F.sum("n_words")).first()[0] or 0
    n_ranges = max(LEAST_RANGES, -(-total // RANGE_WINDOWS))
    done: list[int] = []
    answers: DataFrame | None = None
    for length in doubled(start, until):
        width = FULL if length == until else SHORT
        if answers is None:
            sent = blocks.mapInArrow(_first(length, width, n_ranges), SENT)
        else:
            sent = blocks.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(_further([*done, length], width, n_ranges), SENT)
        found = stage(sent.groupBy("range").applyInArrow(_decide(len(done), width), ANSWER))
        if found.isEmpty():
            return done, answers, n_ranges
        answers = found if answers is None else answers.unionByName(found)
        done.append(length)
    return done, answers, n_ranges


KEPT = "doc_id long, n_words long, n_removed long, kept_sha256 string, kept_text string"


def _cut(lengths: list[int], n_ranges: int, with_text: bool) -> Callable:
    target = lengths[-1]

    def run(blocks: pa.Table, said: pa.Table) -> pa.Table:
        rows = []
        for row in blocks.to_pylist():
            words = _words(row)
            covered = None
            if len(said):
                found = _answers(said, len(lengths))
                if found[-1]:
                    alive, _ = _replay(words, lengths, found, n_ranges)
                    edges = np.zeros(len(words) + 1, np.int64)
                    at = np.flatnonzero(alive)
                    edges[: len(words)][at] += 1
                    edges[at + target] -= 1
                    covered = np.cumsum(edges[:-1]) > 0
            ends = np.cumsum(row["size"], dtype=np.int64)
            for i, doc_id in enumerate(row["doc_id"]):
                a, b = words.first[i], words.first[i + 1]
                parts = row["data"][ends[i] - row["size"][i] : ends[i]].split()
                gone = int(covered[a:b].sum()) if covered is not None else 0
                kept = b" ".join(compress(parts, (~covered[a:b]).tolist()) if gone else parts)
                rows.append((doc_id, int(b - a), gone, hashlib.sha256(kept).hexdigest(), kept.decode() if with_text else None))
        names = ["doc_id", "n_words", "n_removed", "kept_sha256", "kept_text"]
        types = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string()]
        return pa.table({n: pa.array([r[k] for r in rows], t) for k, (n, t) in enumerate(zip(names, types))})

    return run


def substring_dedup(docs: DataFrame, length: int = 35, start: int | None = None, with_text: bool = True) -> DataFrame:
    """Remove every word covered by a window of ``length`` words that also starts elsewhere.

    All occurrences go, in other documents or the same one; windows are judged on the
    input. ``start`` is the length counted first (a quarter of ``length`` by default).
    Columns: doc_id, n_words, n_removed, kept_sha256 and kept_text (kept words joined by
    one space; NULL unless ``with_text``). NULL and empty texts have no words; repeated
    rows are occurrences of their own; an empty table gives no rows.
    """
    blocks = pack_blocks(docs)
    lengths, answers, n_ranges = repeated_windows(blocks, start or max(1, -(-length // 4)), length)
    if not lengths or lengths[-1] != length:  # no window of an earlier level occurs again
        lengths = [*lengths, length]
    if answers is None:
        answers = docs.sparkSession.createDataFrame([], ANSWER)
    return blocks.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(_cut(lengths, n_ranges, with_text), KEPT)
