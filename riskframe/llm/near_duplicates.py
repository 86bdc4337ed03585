"""Near-duplicate classes: ProbMinHash signatures, banding, exact verification, components."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.llm.common import small_batches, stage, text_of
from riskframe.llm.words import Words, mix, ranges, word_batches

SHINGLE, SIMILARITY = 5, 0.8
#: 20 bands of 5: a pair at similarity 0.8 shares a band with probability 0.9996.
BANDS, BAND_ROWS = 20, 5
STEP = np.uint64(0x9E3779B97F4A7C15)
#: A similarity this little below the limit reaches it.
ROUNDING = 1e-9
#: Bytes of shingle sets in a block of a bucket whose members are compared with one another.
BLOCK_BYTES = 4 << 20


def shingles(words: Words, k: int = SHINGLE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text index, shingle hash and count of each distinct shingle of each text.

    A text of fewer than k words is one shingle of all its words; one without words has none.
    """
    at, h = words.windows(k)
    doc = words.doc[at]
    n = np.diff(words.first)
    for size in range(1, k):
        short = np.flatnonzero(n == size)
        if len(short):
            where, hs = words.windows(size)
            own = np.isin(words.doc[where], short)
            doc, h = np.append(doc, words.doc[where[own]]), np.append(h, hs[own])
    order = np.lexsort((h, doc))
    doc, h = doc[order], h[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])
    first = np.flatnonzero(new)
    return doc[first], h[first], np.diff(np.append(first, len(h)))


def prob_min_hash(doc: np.ndarray, element: np.ndarray, weight: np.ndarray, n_docs: int, m: int) -> np.ndarray:
    """ProbMinHash signatures, m components per text, by arrivals of a Poisson process.

    Each element arrives at a rate of its weight, every arrival at a uniformly drawn
    component; a component keeps the element that came first. An element is dropped once
    its next arrival is later than all components of its text. Two texts agree in a
    component with the probability Jaccard similarity of their weighted shingles.
    """
    first = np.full(n_docs * m, np.inf)
    kept = np.zeros(n_docs * m, np.uint64)
    state, time, alive = element.copy(), np.zeros(len(element)), np.arange(len(element))
    while len(alive):
        state[alive] += STEP
        random = mix(state[alive])
        uniform = ((random >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53
        time[alive] -= np.log(uniform) / weight[alive]
        slot = doc[alive] * m + (mix(random ^ STEP) % np.uint64(m)).astype(np.int64)
        np.minimum.at(first, slot, time[alive])
        won = first[slot] == time[alive]
        kept[slot[won]] = element[alive[won]]
        alive = alive[time[alive] < first.reshape(n_docs, m).max(axis=1)[doc[alive]]]
    return kept.reshape(n_docs, m)


def _signer(bands: int, rows: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, words in word_batches(batch):
                doc, h, count = shingles(words)
                n = b - a
                signature = prob_min_hash(doc, h, count, n, bands * rows)
                key = np.zeros((n, bands), np.uint64)
                for i in range(rows):
                    key = mix(key * STEP + signature[:, i::rows] + np.arange(bands, dtype=np.uint64))
                any_word = np.diff(words.first) > 0
                lists = [k if w else [] for k, w in zip(key.view(np.int64).tolist(), any_word)]
                part = batch.slice(a, n)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(lists, pa.list_(pa.int64()))], ["doc_id", "node", "bands"]
                )

    return run


def _weights(count: np.ndarray) -> bytes:
    """Empty where all are 1."""
    return count.astype("<u4").tobytes() if (count > 1).any() else b""


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for a, b, words in word_batches(batch):
            doc, h, count = shingles(words)
            cut = np.searchsorted(doc, np.arange(b - a + 1))
            pairs = [(h[x:y].tobytes(), _weights(count[x:y])) for x, y in zip(cut, cut[1:])]
            columns = [batch.slice(a, b - a).column(0), *(pa.array(c, pa.binary()) for c in zip(*pairs))]
            yield pa.RecordBatch.from_arrays(columns, ["node", "elements", "weights"])


def probability_jaccard(a: np.ndarray, x: np.ndarray, b: np.ndarray, y: np.ndarray) -> float:
    """Exact probability Jaccard of two weighted sets with sorted elements.

    The sum over common i of 1 / sum over all j of max(x_j / x_i, y_j / y_i). The inner sum
    takes x_j / x_i where x_j / y_j is at least x_i / y_i, else y_j / y_i.
    """
    _, i, j = np.intersect1d(a, b, assume_unique=True, return_indices=True)
    if not len(i):
        return 0.0
    cx, cy = x[i].astype(np.float64), y[j].astype(np.float64)
    only_x, only_y = float(x.sum() - cx.sum()), float(y.sum() - cy.sum())
    ratio = cx / cy
    order = np.argsort(ratio, kind="stable")
    cx, cy, ratio = cx[order], cy[order], ratio[order]
    above = np.append(np.cumsum(cx[::-1])[::-1], 0.0) + only_x
    below = np.append(0.0, np.cumsum(cy)) + only_y
    at = np.searchsorted(ratio, ratio, side="left")
    return float((1.0 / (above[at] / cx + below[at] / cy)).sum())


def _verify(least: float) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [batch.column(i) for i in range(2, 6)]
            same = []
            for ea, wa, eb, wb in zip(*columns):
                a, x, b, y = (np.frombuffer(v.as_buffer(), t) for v, t in zip((ea, wa, eb, wb), ("<u8", "<u4") * 2))
                x, y = (w if len(w) else np.ones(len(e), np.uint32) for e, w in ((a, x), (b, y)))
                same.append(bool(len(a) and len(b)) and probability_jaccard(a, x, b, y) >= least - ROUNDING)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(same, pa.bool_())], ["a", "b", "same"])

    return run


def verified_pairs(pairs: DataFrame, sets: DataFrame, least: float) -> DataFrame:
    """Pairs (a, b) with whether their similarity is at least ``least``."""
    left = sets.select(F.col("node").alias("a"), F.col("elements").alias("ea"), F.col("weights").alias("wa"))
    right = sets.select(F.col("node").alias("b"), F.col("elements").alias("eb"), F.col("weights").alias("wb"))
    joined = pairs.join(left, "a").join(right, "b").select("a", "b", "ea", "wa", "eb", "wb")
    return joined.mapInArrow(_verify(least), "a long, b long, same boolean")


def _postings(elements: np.ndarray, share: np.ndarray, member: np.ndarray) -> tuple[np.ndarray, ...]:
    """Elements in order with, for each, where its run starts and stops."""
    order = np.argsort(elements, kind="stable")
    e = elements[order]
    new = np.ones(len(e), bool)
    new[1:] = e[1:] != e[:-1]
    starts = np.flatnonzero(new)
    return e[starts], starts, np.append(starts[1:], len(e)), share[order], member[order]


def block_links(side: np.ndarray, roots: np.ndarray, sets: list[tuple[np.ndarray, np.ndarray]], least: float) -> list[tuple[int, int]]:
    """Links (root, root) that join the classes of all similar pairs of one block, or between two.

    ``side`` tells the two blocks apart; where it is the same for all, every pair is
    compared. Of each text the shared elements are looked up at once. No pair can be more
    similar than the sum of min(x_i / sum x, y_i / sum y), so only pairs where that is
    ``least`` or more are worked out, and none inside a class.
    """
    size = np.array([len(e) for e, _ in sets])
    total = np.array([w.sum() for _, w in sets], np.float64)
    plain = np.array([bool((w == 1).all()) for _, w in sets])
    share = np.concatenate([w / t for (_, w), t in zip(sets, total)])
    distinct, starts, stops, shares, member = _postings(np.concatenate([e for e, _ in sets]), share, np.repeat(np.arange(len(sets)), size))
    two = bool((side != side[0]).any())
    queries = np.flatnonzero(side == side.min())
    number = {r: i for i, r in enumerate(dict.fromkeys(roots.tolist()))}
    group = np.array([number[r] for r in roots.tolist()])
    links = []
    for q in queries:
        other = (group != group[q]) & ((side != side[q]) if two else (np.arange(len(sets)) > q))
        if not other.any():
            continue
        e, w = sets[q]
        at = np.searchsorted(distinct, e)
        counts = stops[at] - starts[at]
        run = ranges(starts[at], counts)
        who = member[run]
        bound = np.bincount(who, np.minimum(shares[run], np.repeat(w / total[q], counts)), len(sets))
        close = np.flatnonzero(other & (bound >= least - ROUNDING))
        common = np.bincount(who, minlength=len(sets))[close]
        exact = np.where(plain[close] & plain[q], common / (size[close] + size[q] - common), np.nan)
        maybe = ~(exact < least - ROUNDING)  # weighted ones are not known yet
        for m, known in zip(close[maybe], ~np.isnan(exact[maybe])):
            if group[m] != group[q] and (known or probability_jaccard(e, w, *sets[m]) >= least - ROUNDING):
                links.append((int(roots[q]), int(roots[m])))
                group[group == group[m]] = group[q]
    return links


def _block_links(least: float) -> Callable:
    def run(members: pa.Table) -> pa.Table:
        members = members.combine_chunks()
        column = {c: members.column(c) for c in ("block", "root", "elements", "weights")}
        sets = []
        for e, w in zip(column["elements"], column["weights"]):
            e, w = np.frombuffer(e.as_buffer(), "<u8"), np.frombuffer(w.as_buffer(), "<u4")
            sets.append((e, w if len(w) else np.ones(len(e), np.uint32)))
        links = block_links(column["block"].to_numpy(), column["root"].to_numpy(), sets, least)
        return pa.table([pa.array(c, pa.int64()) for c in (zip(*links) if links else ([], []))], ["a", "b"])

    return run


def join_classes(roots: DataFrame, links: DataFrame) -> DataFrame:
    """node, root after classes linked by (a, b), their roots, have become one."""
    merged = components(links).select(F.col("node").alias("root"), F.col("root").alias("new"))
    return stage(roots.join(merged, "root", "left").select("node", F.coalesce("new", "root").alias("root")))


def class_roots(members: DataFrame, sets: DataFrame, least: float) -> DataFrame:
    """node, root of the classes: components of all similar pairs that share a bucket.

    No bucket lists its pairs. First each member is compared with one member of its bucket,
    which settles buckets of real near-duplicates. The members of each bucket that still
    holds several classes are dealt to blocks of about ``BLOCK_BYTES``, and each pair of
    blocks is one group of rows, where every pair of different classes is compared. Such a
    group gives fewer links than it has members. Members are sent once per block of their
    bucket: a bucket of n bytes sends n * n / BLOCK_BYTES, and loses no link.
    """
    roots = stage(members.select("node").distinct().withColumn("root", F.col("node")))
    one = members.groupBy("key").agg(F.min("node").alias("one"))
    near = members.join(one, "key").where("node <> one")
    pairs = near.select(F.least("node", "one").alias("a"), F.greatest("node", "one").alias("b")).distinct()
    roots = join_classes(roots, stage(verified_pairs(pairs, sets, least).where("same").select("a", "b")))
    sized = sets.select("node", (F.length("elements") + F.length("weights")).cast("long").alias("bytes"))
    now = stage(members.join(roots, "node").join(sized, "node"))
    mixed = now.groupBy("key").agg(F.min("root").alias("low"), F.max("root").alias("high"), F.sum("bytes").alias("total")).where("low <> high")
    n_blocks = F.ceil(F.col("total") / BLOCK_BYTES)
    dealt = now.where("bytes > 0").join(mixed, "key").select("key", "node", "root", n_blocks.alias("n"), F.pmod(F.xxhash64("node", "key"), n_blocks).alias("block"))
    sent = dealt.select("key", "node", "root", "block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1)).alias("other"))
    sent = sent.select("key", "node", "root", "block", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"))
    grouped = sent.join(sets, "node").select("key", "i", "j", "block", "root", "elements", "weights").groupBy("key", "i", "j")
    return join_classes(roots, stage(grouped.applyInArrow(_block_links(least), "a long, b long").distinct()))


def components(links: DataFrame) -> DataFrame:
    """node, root: the least node of each connected component of links (a, b).

    Roots fall to the least root among neighbours, then along root of root, in staged
    rounds until none changes.
    """
    both = stage(links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    roots = stage(both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("root")).withColumnRenamed("a", "node"))
    while True:
        heard = both.join(roots.select(F.col("node").alias("b"), "root"), "b").groupBy("a").agg(F.min("root").alias("heard"))
        lower = roots.join(heard.withColumnRenamed("a", "node"), "node").select("node", "root", F.least("root", "heard").alias("low"))
        jump = roots.select(F.col("node").alias("low"), F.col("root").alias("further"))
        new = lower.join(jump, "low").select("node", F.least("low", "further").alias("root"), (F.least("low", "further") != F.col("root")).alias("changed"))
        new = stage(new)
        roots = new.select("node", "root")
        if new.where("changed").isEmpty():
            return roots


def rooted_documents(docs: DataFrame, least: float = SIMILARITY, bands: int = BANDS, band_rows: int = BAND_ROWS) -> DataFrame:
    """One row per document: doc_id, node (hash of its text) and root (a node that stands for its class).

    Weighted shingles of five words, weights being counts. Texts are linked when they share
    a band of their ProbMinHash signatures and their exact probability Jaccard similarity is
    at least ``least``; classes are connected components. Equal texts are one node from the
    start, so copies cost nothing further. NULL texts count as empty; empty texts are copies
    of one another, while texts of white space alone are in no class but their copies';
    repeated rows are copies; rows with NULL doc_id take part; an empty table gives no rows;
    further columns are ignored.
    """
    small_batches(docs.sparkSession)
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text_of()).alias("node"), text_of().alias("text"))
    signed = stage(source.mapInArrow(_signer(bands, band_rows), "doc_id long, node long, bands array<long>"))
    nodes = signed.groupBy("node").agg(F.min("doc_id").alias("doc_id"), F.first("bands").alias("bands"))
    keys = stage(nodes.select("node", "doc_id", F.explode("bands").alias("key")))
    crowded = keys.groupBy("key").count().where("count > 1").select("key")
    members = stage(keys.join(crowded, "key", "left_semi"))
    wanted = members.select("node", "doc_id").distinct()
    same = (F.col("w.node") == F.col("s.node")) & F.col("w.doc_id").eqNullSafe(F.col("s.doc_id"))
    texts = source.alias("s").join(wanted.alias("w"), same, "left_semi").select("s.node", "s.text")
    sets = stage(texts.mapInArrow(_sets, "node long, elements binary, weights binary").dropDuplicates(["node"]))
    roots = class_roots(members.select("key", "node"), sets, least)
    rooted = signed.select("doc_id", "node").join(roots, "node", "left")
    return stage(rooted.select("doc_id", "node", F.coalesce("root", "node").alias("root")))


def near_duplicates(docs: DataFrame, least: float = SIMILARITY, bands: int = BANDS, band_rows: int = BAND_ROWS) -> DataFrame:
    """One row per document: doc_id, class_id (least doc_id of its class) and n_class (rows).

    Classes are those of ``rooted_documents``; one of rows with NULL doc_id alone has a NULL class_id.
    """
    rooted = rooted_documents(docs, least, bands, band_rows)
    classes = rooted.groupBy("root").agg(F.min("doc_id").alias("class_id"), F.count("*").alias("n_class"))
    return rooted.join(classes, "root").select("doc_id", "class_id", "n_class")
