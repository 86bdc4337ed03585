"""Benchmark decontamination: n-gram seeds, then Smith-Waterman alignment of words."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.llm.common import small_batches, stage, text_of
from riskframe.llm.words import SPACE, Words, ranges, text_buffer, word_batches

SEED_WORDS = 3
MATCH, MISMATCH, GAP = 2, -1, -1
#: Bytes of benchmark text that one pass over the documents looks for.
BLOCK_BYTES = 8 << 20

#: ASCII punctuation separates words here, as spaces do.
SEPARATORS = SPACE.copy()
SEPARATORS[33:48] = SEPARATORS[58:65] = SEPARATORS[91:97] = SEPARATORS[123:128] = True
HOW = {"lower": True, "space": SEPARATORS}


def _grams(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """First word and hash of each n-gram; a text of fewer words is one n-gram."""
    at, h = words.windows(SEED_WORDS)
    n = np.diff(words.first)
    for size in range(1, SEED_WORDS):
        if (n == size).any():
            where, hs = words.windows(size)
            own = n[words.doc[where]] == size
            at, h = np.append(at, where[own]), np.append(h, hs[own])
    return at, h


class Items:
    """One block of benchmark items: word hashes and, per n-gram, the items and places that hold it."""

    def __init__(self, ids: list, texts: list[str]):
        data, offsets = text_buffer(pa.array(texts, pa.string()))
        words = Words(data, offsets, **HOW)
        self.ids, self.first, self.hash, self.doc = ids, words.first, words.hash, words.doc
        at, h = _grams(words)
        order = np.argsort(h, kind="stable")
        self.at, self.gram = at[order], h[order]

    def words(self, item: int) -> np.ndarray:
        return self.hash[self.first[item] : self.first[item + 1]]

    def hits(self, grams: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index of an n-gram of ``grams`` and of an equal entry here, for all equal pairs."""
        a = np.searchsorted(self.gram, grams, "left")
        b = np.searchsorted(self.gram, grams, "right")
        n = b - a
        some = np.flatnonzero(n)
        return np.repeat(some, n[some]), ranges(a[some], n[some])


def local_alignment(item: np.ndarray, text: np.ndarray, anchored: bool = False) -> tuple[int, int, int]:
    """Best Smith-Waterman score of two word sequences, and the words of ``text`` and ``item`` up to its end.

    ``anchored``: only alignments from the first words of both count.
    """
    column = np.arange(len(text) + 1)
    row, best, end, used = GAP * column if anchored else np.zeros(len(text) + 1, np.int64), 0, 0, 0
    for i, word in enumerate(item, 1):
        new = row + GAP if anchored else np.maximum(row + GAP, 0)
        np.maximum(new[1:], row[:-1] + np.where(text == word, MATCH, MISMATCH), out=new[1:])
        row = np.maximum.accumulate(new - GAP * column) + GAP * column  # gaps along the text
        top = int(row.argmax())
        if row[top] > best:
            best, end, used = int(row[top]), top, i
    return best, end, used


def passages(sought: np.ndarray, text: np.ndarray, least: float) -> Iterator[tuple[int, int, int]]:
    """Score, first word and stop of the best alignment in ``text``, then of those in what is left on either side.

    A word of the text matches once at most, so a part with too few words of the item is
    not aligned.
    """
    known, needed = np.isin(text, sought), least * MATCH * len(sought)
    parts = [(0, len(text))]
    while parts:
        x, y = parts.pop()
        if MATCH * int(known[x:y].sum()) < needed:
            continue
        score, stop, used = local_alignment(sought, text[x:y])
        if score < needed or not score:
            continue
        _, back, _ = local_alignment(sought[:used][::-1], text[x : x + stop][::-1], anchored=True)
        start, stop = x + stop - back, x + stop
        yield score, start, stop
        parts += [(x, start), (stop, y)]


def _regions(starts: np.ndarray, stops: np.ndarray) -> Iterator[tuple[int, int]]:
    order = np.argsort(starts, kind="stable")
    low, high = None, None
    for a, b in zip(starts[order], stops[order]):
        if low is None:
            low, high = a, b
        elif a <= high:
            high = max(high, b)
        else:
            yield int(low), int(high)
            low, high = a, b
    if low is not None:
        yield int(low), int(high)


FOUND = "doc_id long, node long, item_id long, score double, first_word long, last_word long"
FOUND_TYPES = [pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.int64(), pa.int64()]


def _align(items: Items, least: float) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            doc_ids, nodes = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for a, _, words in word_batches(batch, **HOW):
                at, h = _grams(words)
                mine, theirs = items.hits(h)
                place, there = at[mine], items.at[theirs]
                doc, item = words.doc[place], items.doc[there]
                origin = place - (there - items.first[item])
                order = np.lexsort((item, doc))
                cuts = np.flatnonzero((np.diff(doc[order]) != 0) | (np.diff(item[order]) != 0)) + 1
                for group in np.split(order, cuts) if len(order) else []:
                    d, i = int(doc[group[0]]), int(item[group[0]])
                    sought = items.words(i)
                    # an alignment that scores enough has no room for more gaps
                    slack = max(8, math.ceil(MATCH * len(sought) * (1 - least) / -GAP))
                    begin, end = words.first[d], words.first[d + 1]
                    low = np.maximum(origin[group] - slack, begin)
                    high = np.minimum(origin[group] + len(sought) + slack, end)
                    for x, y in _regions(low, high):
                        known = np.append(0, np.cumsum(np.isin(words.hash[x:y], sought)))
                        inside = (low >= x) & (high <= y)
                        lows, highs = low[inside], high[inside]
                        enough = MATCH * (known[highs - x] - known[lows - x]) >= least * MATCH * len(sought)
                        for u, v in _regions(lows[enough], highs[enough]):
                            for score, start, stop in passages(sought, words.hash[u:v], least):
                                share = score / (MATCH * len(sought))
                                rows.append((doc_ids[a + d], nodes[a + d], items.ids[i], share, u + start - begin, u + stop - 1 - begin))
            columns = list(zip(*rows)) if rows else [[]] * 6
            yield pa.RecordBatch.from_arrays(
                [pa.array(map(t.to_pandas_dtype(), c) if k >= 3 else c, t) for k, (c, t) in enumerate(zip(columns, FOUND_TYPES))],
                [c.split()[0] for c in FOUND.split(", ")],
            )

    return run


def contaminated(docs: DataFrame, benchmark: DataFrame, least: float = 0.5) -> DataFrame:
    """Passages of documents that align with a benchmark item.

    Words are compared in lower case (A-Z) without ASCII punctuation. Every
    three-word n-gram of an item is a seed; a document that holds a seed is aligned with the
    item around it, as far as an alignment of ``least`` can reach, and again on either side
    of each passage found. Items of one or two words are sought only as whole texts: in
    documents of exactly those words. One row per passage whose local alignment score is at least ``least`` of a whole match: doc_id,
    node (hash of the text), item_id, score (share of a whole match), first_word and
    last_word (of the passage, in the document's words). A word of the document that is
    replaced, missing or added lowers the score and does not end the passage.

    The benchmark is sought in blocks of bounded size, one pass over the documents each.
    NULL and empty texts match nothing, items without words are sought by nothing; repeated
    rows are repeated in the result; further columns are ignored.
    """
    spark = docs.sparkSession
    small_batches(spark)
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text_of()).alias("node"), text_of().alias("text"))
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), text_of().alias("text"))
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n_blocks = -(-total // BLOCK_BYTES) or 1
    out = None
    for block in range(n_blocks):
        rows = items.where(F.pmod(F.xxhash64("text"), F.lit(n_blocks)) == block).orderBy("item_id", "text").collect()
        if not rows:
            continue
        sought = Items([r["item_id"] for r in rows], [r["text"] for r in rows])
        found = source.mapInArrow(_align(sought, least), FOUND)
        out = found if out is None else out.unionByName(found)
    return out if out is not None else spark.createDataFrame([], FOUND)
