"""Cross-tokenizer alignment: groups of tokens of two tokenizers that span the same bytes, and their links.

Texts up to ``chunk_bytes`` are aligned where they are read. Longer ones are dealt out as
byte ranges; each gives a fragment (open prefix, closed groups, open suffix; see
``fragments``), and fragments of neighbouring ranges are composed in a tree of joins of
``FAN`` at a time. Only open ends climb the tree; closed groups stay with their range, and
groups that close between ranges are rows of their own.

The links of a task's texts are kept per block: a list of its different id pairs, and per
text the numbers of its pairs with their counts. Counts over the corpus are sums of the
blocks' lists; they come back to a block as one row per different pair, so neither texts
nor single links are shuffled, and a block bounds what a task holds.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.llm.common import small_batches, stage, text_of
from riskframe.llm.fragments import Fragment, TwoTokenizers

CHUNK_BYTES = 1 << 16
#: Bytes and rows of the texts of one block of links.
BLOCK_BYTES, BLOCK_ROWS = 8 << 20, 20_000
#: Fragments composed at once.
FAN = 16

PART = (
    "kind string, uid string, doc_id long, chunk int, start int, stop int, bytes binary, n_a long, n_b long, n_groups long, "
    "n_links long, groups binary, groups_sha256 string, block string, numbers binary, times binary, cut boolean, pre_a array<int>, "
    "pre_b array<int>, suf_a array<int>, suf_b array<int>, a array<int>, b array<int>, n array<long>"
)
_TYPES = {
    "string": pa.string(), "long": pa.int64(), "int": pa.int32(), "binary": pa.binary(), "boolean": pa.bool_(),
    "array<int>": pa.list_(pa.int32()), "array<long>": pa.list_(pa.int64()),
}


def _batch(rows: list[dict], schema: str) -> pa.RecordBatch:
    fields = [f.split() for f in schema.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array([r.get(n) for r in rows], _TYPES[t]) for n, t in fields], [n for n, _ in fields])


_aligners: dict[tuple[str, str], TwoTokenizers] = {}


def _aligner(paths: tuple[str, str]) -> TwoTokenizers:
    if paths not in _aligners:
        _aligners[paths] = TwoTokenizers(*paths)
    return _aligners[paths]


class _Block:
    """Rows with links, collected until the block is full."""

    def __init__(self, limit: int):
        self.limit, self.rows, self.codes, self.times, self.size = limit, [], [], [], 0

    def add(self, row: dict, found: tuple[bytes, np.ndarray, int], size: int) -> None:
        groups, links, n_a = found
        codes, times = np.unique(links, return_counts=True)
        n_links, n_groups = len(links), groups.count(b"|")
        row |= {"n_a": n_a, "n_b": n_links + n_groups - n_a, "n_groups": n_groups, "n_links": n_links}
        self.rows.append(row)
        self.codes.append(codes)
        self.times.append(times)
        self.size += size

    def full(self) -> bool:
        return self.size >= self.limit or len(self.rows) >= BLOCK_ROWS

    def take(self) -> Iterator[pa.RecordBatch]:
        """The rows, numbered by the block's pairs, and the pairs with their counts."""
        if self.rows:
            pairs, numbers = np.unique(np.concatenate(self.codes), return_inverse=True)
            times = np.concatenate(self.times).astype(np.int64)
            total = np.zeros(len(pairs), np.int64)
            np.add.at(total, numbers, times)
            block, at = uuid.uuid4().hex, 0
            for row, codes in zip(self.rows, self.codes):
                part = slice(at, at := at + len(codes))
                row |= {"block": block, "numbers": numbers[part].astype("<u4").tobytes(), "times": times[part].astype("<u4").tobytes()}
            for i in range(0, len(self.rows), 2000):
                yield _batch(self.rows[i : i + 2000], PART)
            yield _batch([{
                "kind": "pairs", "block": block, "a": (pairs >> np.uint64(32)).astype(np.int32),
                "b": (pairs & np.uint64(0xFFFFFFFF)).astype(np.int32), "n": total,
            }], PART)
        self.rows, self.codes, self.times, self.size = [], [], [], 0


def _texts(paths: tuple[str, str], chunk_bytes: int, block_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        two, block = _aligner(paths), _Block(block_bytes)
        for batch in batches:
            others = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                whole = b" " + text.as_buffer().to_pybytes()
                found = None
                if len(whole) > chunk_bytes and two.safe and two.keeps(text.as_py()):
                    uid = uuid.uuid4().hex
                    for k, (lo, start, end, hi) in enumerate(two.cuts(whole, chunk_bytes)):
                        others.append({
                            "kind": "range", "uid": uid, "doc_id": doc_id, "chunk": k, "start": start - lo, "stop": end - lo, "bytes": whole[lo:hi],
                        })
                        if len(others) * chunk_bytes > block_bytes:
                            yield _batch(others, PART)
                            others = []
                    continue
                if len(whole) > 1:
                    found = two.whole(whole)
                if found:
                    block.add({"kind": "text", "doc_id": doc_id, "groups_sha256": hashlib.sha256(found[0]).hexdigest()}, found, len(whole))
                else:
                    others.append({"kind": "none", "doc_id": doc_id, "groups_sha256": ""})
                if block.full():
                    yield from block.take()
            if others:
                yield _batch(others, PART)
        yield from block.take()

    return run


def _ranges(paths: tuple[str, str], block_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        two, block = _aligner(paths), _Block(block_bytes)
        for batch in batches:
            for r in batch.to_pylist():
                f, found = two.fragment(r["bytes"], r["start"], r["stop"], r["chunk"] == 0)
                row = {"kind": "range", "uid": r["uid"], "doc_id": r["doc_id"], "chunk": r["chunk"], "groups": found[0], "cut": f.cut}
                row |= {"pre_a": f.pre_a, "pre_b": f.pre_b, "suf_a": f.suf_a, "suf_b": f.suf_b}
                block.add(row, found, len(r["bytes"]))
                if block.full():
                    yield from block.take()
        yield from block.take()

    return run


SEAM = "kind string, uid string, chunk int, closer int, cut boolean, pre_a array<int>, pre_b array<int>, suf_a array<int>, suf_b array<int>"


def _compose(table: pa.Table) -> pa.Table:
    """Fragments of one document and neighbouring ranges to one, with the groups that close between them."""
    rows = sorted(table.to_pylist(), key=lambda r: r["chunk"])
    state, out = Fragment(), []
    for r in rows:
        state, group = state.then(Fragment(r["cut"], r["pre_a"], r["pre_b"], r["suf_a"], r["suf_b"]))
        if group:
            out.append({"kind": "seam", "uid": r["uid"], "chunk": r["closer"], "pre_a": group[0], "pre_b": group[1]})
    joint = {"kind": "fragment", "uid": rows[0]["uid"], "chunk": rows[0]["chunk"] // FAN, "cut": state.cut}
    # the open prefix ends in the first range with a common end
    joint["closer"] = next((r["closer"] for r in rows if r["cut"]), rows[0]["closer"])
    joint |= {"pre_a": state.pre_a, "pre_b": state.pre_b, "suf_a": state.suf_a, "suf_b": state.suf_b}
    return pa.Table.from_batches([_batch([*out, joint], SEAM)])


def compose_tree(ranges: DataFrame) -> DataFrame:
    """The groups that close between ranges: uid, chunk (of the range before whose closed groups they stand), pre_a, pre_b.

    Each round composes ``FAN`` neighbours at a time, until each document is one fragment.
    """
    level = ranges.select(
        F.lit("fragment").alias("kind"), "uid", "chunk", F.col("chunk").alias("closer"), "cut", "pre_a", "pre_b", "suf_a", "suf_b"
    )
    most = ranges.agg(F.max("chunk")).head()[0] or 0
    seams = level.where("false")
    while most > 0:
        out = stage(level.groupBy("uid", F.floor(F.col("chunk") / FAN)).applyInArrow(_compose, SEAM))
        seams = seams.unionByName(out.where("kind = 'seam'"))
        level = out.where("kind = 'fragment'")
        most //= FAN
    return seams.select("uid", "chunk", "pre_a", "pre_b")


def _hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of each document's groups, from texts in order."""
    uid, state, out = None, None, []
    for batch in batches:
        for name, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            if name != uid:
                if uid is not None:
                    out.append((uid, state.hexdigest()))
                uid, state, joint = name, hashlib.sha256(), b""
            if text.as_py():
                state.update(joint + text.as_py())
                joint = b";"
        if len(out) > 1000:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in zip(*out)], ["uid", "groups_sha256"])
            out = []
    if uid is not None:
        out.append((uid, state.hexdigest()))
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in zip(*out)], ["uid", "groups_sha256"])


def _counted(rows: pa.Table, pairs: pa.Table) -> pa.Table:
    """Sums over the links of each row of a block, by the counts of the block's pairs."""
    order = np.argsort(pairs.column("number").to_numpy())
    count = pairs.column("count").to_numpy()[order]
    best = pairs.column("best").to_numpy(zero_copy_only=False)[order].astype(np.int64)
    sums, bests = [], []
    for numbers, times in zip(rows.column("numbers"), rows.column("times")):
        at, n = np.frombuffer(numbers.as_buffer(), "<u4"), np.frombuffer(times.as_buffer(), "<u4").astype(np.int64)
        sums.append(int(np.dot(count[at], n)))
        bests.append(int(np.dot(best[at], n)))
    kept = rows.drop_columns(["block", "numbers", "times"])
    return kept.append_column("n_best", pa.array(bests, pa.int64())).append_column("count_sum", pa.array(sums, pa.int64()))


COUNTED = "kind string, uid string, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, n_best long, count_sum long"
RESULT = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def aligned_parts(
    docs: DataFrame, byte_level: str, pieces: str, chunk_bytes: int = CHUNK_BYTES, block_bytes: int = BLOCK_BYTES
) -> tuple[DataFrame, DataFrame]:
    """Aligned texts and byte ranges with their blocks of links, and the groups that close between ranges."""
    small_batches(docs.sparkSession)
    paths = (byte_level, pieces)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    first = stage(texts.mapInArrow(_texts(paths, chunk_bytes, block_bytes), PART))
    dealt = first.where("kind = 'range'").repartition("uid", "chunk")
    ranges = stage(dealt.mapInArrow(_ranges(paths, block_bytes), PART))
    seams = stage(compose_tree(ranges.where("kind = 'range'")))
    return first.where("kind <> 'range'").unionByName(ranges), seams


def align(
    docs: DataFrame, byte_level: str, pieces: str, chunk_bytes: int = CHUNK_BYTES, block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """Groups and links of the tokens of two tokenizers, one row per document.

    ``byte_level`` is a file of the tokenizers library with byte-level entries (A),
    ``pieces`` a model of the sentencepiece library (B); both encode a space and the text,
    special tokens are plain text. Columns: doc_id, n_a, n_b (tokens), n_groups, n_links
    (pairs of overlapping occurrences), n_best (links whose id pair is the most frequent
    one of its B id in the corpus, ties included), count_sum (corpus counts of the links'
    pairs), groups_sha256 (of ``a1,a2|b1;a3|b2`` …).

    NULL and empty texts, and those that the tokens do not spell byte by byte, have zeros
    and an empty digest, and their links are not counted. NULL ids and repeated rows are
    documents of their own; an empty table gives no rows; further columns are ignored. A
    text is cut at any byte; a stretch without a space between two other characters is
    encoded as a whole by one task.
    """
    parts, seams = aligned_parts(docs, byte_level, pieces, chunk_bytes, block_bytes)
    lists = parts.where("kind = 'pairs'").select("block", F.posexplode(F.arrays_zip("a", "b", "n")).alias("number", "p"))
    lists = lists.select("block", "number", "p.a", "p.b", "p.n")
    two = _seam_links(paths=(byte_level, pieces))
    between = stage(seams.mapInArrow(two, "uid string, chunk int, groups binary, n_a long, n_b long, a array<int>, b array<int>"))
    links = between.select("uid", F.explode(F.arrays_zip("a", "b")).alias("p")).select("uid", "p.a", "p.b")
    every = lists.select("a", "b", "n").unionByName(links.select("a", "b", F.lit(1).cast("long").alias("n")))
    counts = stage(every.groupBy("a", "b").agg(F.sum("n").alias("count")))
    most = counts.groupBy("b").agg(F.max("count").alias("most"))
    counts = stage(counts.join(most, "b").select("a", "b", "count", (F.col("count") == F.col("most")).alias("best")))

    rows = parts.where("kind in ('text', 'range')").select(*[c.split()[0] for c in COUNTED.split(", ")[:-2]], "block", "numbers", "times")
    back = lists.join(counts, ["a", "b"]).select(F.col("block").alias("of_block"), "number", "count", "best")
    counted = stage(rows.groupBy("block").cogroup(back.groupBy("of_block")).applyInArrow(_counted, COUNTED))

    sums = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum"]
    of_links = links.join(counts, ["a", "b"]).groupBy("uid").agg(
        F.count("*").alias("n_links"), F.sum(F.col("best").cast("long")).alias("n_best"), F.sum("count").alias("count_sum")
    )
    of_groups = between.groupBy("uid").agg(F.sum("n_a").alias("n_a"), F.sum("n_b").alias("n_b"), F.count("*").alias("n_groups"))
    seam_sums = of_groups.join(of_links, "uid").select("uid", F.lit(None).cast("long").alias("doc_id"), *sums)
    ranged = counted.where("kind = 'range'").select("uid", "doc_id", *sums).unionByName(seam_sums)
    ranged = ranged.groupBy("uid").agg(F.max("doc_id").alias("doc_id"), *[F.sum(c).alias(c) for c in sums])
    closed = parts.where("kind = 'range'").select("uid", "chunk", F.lit(1).alias("side"), "groups")
    in_order = closed.unionByName(between.select("uid", "chunk", F.lit(0).alias("side"), "groups"))
    in_order = in_order.repartition("uid").sortWithinPartitions("uid", "chunk", "side").select("uid", "groups")
    digests = in_order.mapInArrow(_hashes, "uid string, groups_sha256 string")
    none = parts.where("kind = 'none'").select("doc_id", *[F.lit(0).cast("long").alias(c) for c in sums], "groups_sha256")
    return (
        counted.where("kind = 'text'").select(RESULT)
        .unionByName(ranged.join(digests, "uid").select(RESULT))
        .unionByName(none.select(RESULT))
    )


def _seam_links(paths: tuple[str, str]):
    """Text, tokens and links of groups that close between ranges."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        two = _aligner(paths)
        for batch in batches:
            rows = []
            for r in batch.to_pylist():
                text, links, n_a = two.closed(np.array(r["pre_a"], np.int64), np.array(r["pre_b"], np.int64))
                rows.append({
                    "uid": r["uid"], "chunk": r["chunk"], "groups": text, "n_a": n_a, "n_b": len(r["pre_b"]),
                    "a": (links >> np.uint64(32)).astype(np.int32), "b": (links & np.uint64(0xFFFFFFFF)).astype(np.int32),
                })
            if rows:
                yield _batch(rows, "uid string, chunk int, groups binary, n_a long, n_b long, a array<int>, b array<int>")

    return run
