"""Prefix trie of conversations, and subtree totals by parallel tree contraction.

A prefix is known by four sums of its turns' hashes times weights of their places, modulo a
prime: sums can be taken over any stretch of a conversation, so a conversation may span
many tasks. Totals over subtrees come from rounds of joins: each round rakes all leaves
into their parents and compresses every chain of nodes with one child, by pointer
doubling, to its bottom; when nothing is left, the compressed nodes are expanded again,
last round first. A round leaves at most half as many leaves, so there are few.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskframe.llm.common import small_batches, stage, text_of

WORD = r"[^\x20\x09-\x0D]+"
PRIME = (1 << 31) - 1
PARTS = range(4)
#: Chain nodes that look up their bottom under one key.
SALT_ROWS = 4_096
#: Bytes of joined ids in one row.
LIST_BYTES = 1 << 16

EARLIER = (Window.unboundedPreceding, -1)


def running(rows: DataFrame, key: str, order: str, sums: list[str]) -> DataFrame:
    """``rows`` with the sums over earlier rows of their key, as ``before_<column>``.

    Rows are dealt by ranges of key and order, so a key may span many tasks. Each task
    numbers its own; what earlier tasks hold of a key concerns only the first key of a
    task, so that table has at most one row per task and is broadcast.
    """
    dealt = stage(rows.repartitionByRange(key, order).withColumn("_task", F.spark_partition_id()))
    inside = Window.partitionBy("_task", key).orderBy(order).rowsBetween(*EARLIER)
    earlier = Window.partitionBy(key).orderBy("_task").rowsBetween(*EARLIER)
    tasks = dealt.groupBy("_task", key).agg(*[F.sum(c).alias(f"_{c}") for c in sums])
    tasks = tasks.select("_task", key, *[F.sum(f"_{c}").over(earlier).alias(f"_{c}") for c in sums]).where(F.col(f"_{sums[0]}").isNotNull())
    found = dealt.select("*", *[F.coalesce(F.sum(c).over(inside), F.lit(0)).alias(f"before_{c}") for c in sums])
    found = found.join(F.broadcast(tasks), ["_task", key], "left")
    total = {f"before_{c}": F.col(f"before_{c}") + F.coalesce(F.col(f"_{c}"), F.lit(0)) for c in sums}
    return found.withColumns(total).drop("_task", *[f"_{c}" for c in sums])


def numbered_turns(conversations: DataFrame) -> DataFrame:
    """conv_id, pos (from 1), digest (of role and text) and words of each turn.

    Turns are ordered by ``turn`` (NULL first), ties by the digest; equal rows are turns of
    their own. Rows without conv_id belong to no conversation.
    """
    role, text = text_of("role"), text_of("text")
    rows = conversations.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256).alias("digest"),
        F.regexp_count(text, F.lit(WORD)).cast("long").alias("words"),
    )
    rows = rows.groupBy("conv_id", "turn", "digest").agg(F.max("words").alias("words"), F.count("*").alias("n"))
    rows = rows.withColumn("place", F.struct("turn", "digest")).select("conv_id", "place", "words", "n")
    placed = running(rows, "conv_id", "place", ["n"])
    every = F.explode(F.sequence(F.col("before_n") + 1, F.col("before_n") + F.col("n"))).alias("pos")
    return stage(placed.select("conv_id", every, F.col("place.digest").alias("digest"), "words"))


def shared_heads(turns: DataFrame, stride: int = 20, most: int = 4) -> tuple[DataFrame, DataFrame]:
    """Conversations (conv_id, depth) and their turns (conv_id, pos, digest, words, depth), rebuilt on shared beginnings.

    The first h turns of conversation c are those of conversation c - c % ``stride`` (all
    it has if fewer, none if it is absent), where h is the crc32 of c's digits modulo
    ``most``; the rest are c's own after its first h. ``%`` is SQL's: it keeps the sign.
    """
    h = F.crc32(F.col("conv_id").cast("string")) % most
    convs = turns.groupBy("conv_id").agg(F.count("*").alias("n")).withColumn("h", h)
    convs = convs.withColumn("head", F.col("conv_id") - F.col("conv_id") % stride)
    lengths = convs.where("conv_id = head").select("head", F.col("n").alias("n_head"))
    convs = convs.join(lengths, "head", "left").withColumn("k", F.least("h", F.coalesce("n_head", F.lit(0))))
    convs = stage(convs.withColumn("depth", F.col("k") + F.greatest(F.lit(0), F.col("n") - F.col("h"))))
    heads = turns.where((F.col("conv_id") % stride == 0) & (F.col("pos") < most)).withColumnRenamed("conv_id", "head")
    first = convs.join(heads, "head").where("pos <= k").select("conv_id", "pos", "digest", "words", "depth")
    own = turns.join(convs.select("conv_id", "h", "k", "depth"), "conv_id").where("pos > h")
    own = own.select("conv_id", (F.col("pos") - F.col("h") + F.col("k")).alias("pos"), "digest", "words", "depth")
    return convs.select("conv_id", "depth"), stage(first.unionByName(own))


def as_they_are(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Conversations and turns as ``shared_heads`` gives them, unchanged."""
    convs = turns.groupBy("conv_id").agg(F.count("*").alias("depth"))
    return convs, stage(turns.join(convs, "conv_id"))


def with_prefixes(turns: DataFrame) -> DataFrame:
    """Turns with the keys of the prefix that ends with them (k1, k2) and of the one before (p1, p2)."""
    terms = {}
    for i in PARTS:
        value = F.conv(F.substring("digest", 1 + 8 * i, 8), 16, 10).cast("long") % PRIME
        terms[f"s{i}"] = value * F.pmod(F.xxhash64(F.lit(i), F.col("pos")), F.lit(PRIME)) % PRIME
    placed = running(turns.withColumns(terms).drop("digest"), "conv_id", "pos", list(terms))

    def pair(i: int, j: int, own: bool) -> Column:
        a, b = (F.col(f"before_s{x}") + (F.col(f"s{x}") if own else F.lit(0)) for x in (i, j))
        return F.shiftleft(a % PRIME, 31) + b % PRIME

    return placed.select(
        "conv_id", F.col("pos").alias("depth"), (F.col("pos") == F.col("depth")).alias("ends"), "words",
        pair(0, 1, True).alias("k1"), pair(2, 3, True).alias("k2"), pair(0, 1, False).alias("p1"), pair(2, 3, False).alias("p2"),
    )


def _lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Ids of equal keys in a row, joined by commas, in pieces of about LIST_BYTES."""
    names, key, first, ids, size = ["depth", "k1", "k2", "first", "ids"], None, 0, [], 0
    for batch in batches:
        rows = []
        for *k, conv_id in zip(*(c.to_pylist() for c in batch.columns)):
            if k != key or size > LIST_BYTES:
                if ids:
                    rows.append((*key, first, ",".join(ids)))
                key, first, ids, size = k, conv_id, [], 0
            ids.append(str(conv_id))
            size += len(ids[-1])
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows)], names)
    if ids:
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip((*key, first, ",".join(ids)))], names)


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of the pieces of each key, joined by commas."""
    names, key, state = ["depth", "k1", "k2", "ends_sha256"], None, None
    for batch in batches:
        rows = []
        for *k, ids in zip(*(c.to_pylist() for c in batch.columns)):
            if k != key:
                if key:
                    rows.append((*key, state.hexdigest()))
                key, state = k, hashlib.sha256(ids.encode())
            else:
                state.update(b"," + ids.encode())
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows)], names)
    if key:
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip((*key, state.hexdigest()))], names)


def ends_digests(ends: DataFrame) -> DataFrame:
    """depth, k1, k2 and the SHA-256 of their conv_ids, ascending and joined by commas.

    Ids are joined where ranges of (key, conv_id) put them, then the pieces are hashed in
    order: a key may hold any share of the ids.
    """
    small_batches(ends.sparkSession)
    key, order = ["depth", "k1", "k2"], ["depth", "k1", "k2", "conv_id"]
    ranged = ends.select(order).repartitionByRange(*order).sortWithinPartitions(*order)
    lists = ranged.mapInArrow(_lists, "depth long, k1 long, k2 long, first long, ids string")
    dealt = lists.repartition(*key).sortWithinPartitions(*key, "first").select(*key, "ids")
    return dealt.mapInArrow(_digests, "depth long, k1 long, k2 long, ends_sha256 string")


def _double(chain: DataFrame, values: list[str]) -> DataFrame:
    """Chain nodes pointed to the bottom of their chain, by doubling; ``chain`` has id, to, dist and to_<value>."""
    current = stage(chain.withColumn("open", F.lit(True)))
    while not current.where("open").isEmpty():
        target = current.select(
            F.col("id").alias("to"), F.col("to").alias("next"), F.col("dist").alias("more"), *[F.col(f"to_{v}").alias(f"next_{v}") for v in values]
        )
        found = F.col("next").isNotNull()
        moved = current.where("open").join(target, "to", "left").select(
            "id", F.coalesce("next", "to").alias("to"), (F.col("dist") + F.coalesce("more", F.lit(0))).alias("dist"), "parent",
            *[f"extra_{v}" for v in values],
            *[(F.col(f"to_{v}") + F.coalesce(f"next_{v}", F.lit(0))).alias(f"to_{v}") for v in values], found.alias("open"),
        )
        current = stage(current.where("not open").unionByName(moved))
    return current.drop("open")


def subtree_sums(nodes: DataFrame, values: list[str]) -> DataFrame:
    """Sums of ``values`` over each node's subtree: id and the values.

    ``nodes`` has id, parent (NULL for roots) and the values. Each round: leaves are done
    and their sums go to the parents, added up before they are joined; then each chain of
    nodes with one child is replaced by an edge from its bottom to the parent of its top,
    which carries the chain's sums (``extra``). Backwards, a chain node is its bottom's
    sum and what lies between.
    """
    active = stage(nodes.select("id", "parent", *values, *[F.lit(0).cast("long").alias(f"extra_{v}") for v in values]))
    done, rounds = [active.where("false").select("id", *values)], []
    while not active.isEmpty():
        parents = active.where("parent is not null").groupBy("parent").agg(F.lit(False).alias("leaf")).withColumnRenamed("parent", "id")
        marked = stage(active.join(parents, "id", "left").withColumn("leaf", F.coalesce("leaf", F.lit(True))))
        done.append(marked.where("leaf").select("id", *values))
        by_parent = marked.where("parent is not null").groupBy("parent").agg(
            F.count(F.when(~F.col("leaf"), 1)).alias("n"),
            F.min(F.when(~F.col("leaf"), F.struct("id", *[f"extra_{v}" for v in values]))).alias("only"),
            *[F.sum(F.when(F.col("leaf"), F.col(v) + F.col(f"extra_{v}"))).alias(f"raked_{v}") for v in values],
        ).withColumnRenamed("parent", "id")
        rest = marked.where("not leaf").join(by_parent, "id")
        rest = stage(rest.withColumns({v: F.col(v) + F.coalesce(f"raked_{v}", F.lit(0)) for v in values}))
        chain = rest.where("n = 1").select(
            "id", F.col("only.id").alias("to"), F.lit(1).cast("long").alias("dist"), "parent", *[f"extra_{v}" for v in values],
            *[(F.col(v) + F.col(f"only.extra_{v}")).alias(f"to_{v}") for v in values],
        )
        others = rest.where("n <> 1").select("id", "parent", *values, *[f"extra_{v}" for v in values])
        if not chain.isEmpty():
            chain = _double(chain, values)
            rounds.append(chain)
            top = F.max(F.struct("dist", "parent", *[(F.col(f"to_{v}") + F.col(f"extra_{v}")).alias(v) for v in values])).alias("top")
            tops = chain.groupBy("to").agg(top).withColumnRenamed("to", "id")
            cut = others.join(tops, "id", "left")
            others = cut.select(
                "id", F.when(F.col("top").isNull(), F.col("parent")).otherwise(F.col("top.parent")).alias("parent"), *values,
                *[F.coalesce(f"top.{v}", f"extra_{v}").alias(f"extra_{v}") for v in values],
            )
        active = stage(others)
    return _expanded(done, rounds, values)


def _expanded(done: list[DataFrame], rounds: list[DataFrame], values: list[str]) -> DataFrame:
    """All sums, from those of the raked nodes by round and the compressed nodes of each round."""
    known = done[0]
    for later in done[1:]:
        known = known.unionByName(later)
    for chain in reversed(rounds):
        # a bottom is sent once for each SALT_ROWS nodes above it
        salt = F.floor(F.col("dist") / SALT_ROWS)
        copies = chain.groupBy("to").agg(F.max(salt).alias("most"))
        bottoms = copies.join(known.withColumnRenamed("id", "to"), "to")
        bottoms = bottoms.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), "most"))).drop("most")
        above = chain.withColumn("salt", salt).join(bottoms, ["to", "salt"])
        known = known.unionByName(stage(above.select("id", *[(F.col(v) + F.col(f"to_{v}")).alias(v) for v in values])))
    return known


def prefix_trie(conversations: DataFrame, stride: int | None = None, most: int = 4) -> DataFrame:
    """Nodes of the trie of all conversations, which have conv_id, turn, role and text.

    A node is a distinct sequence of first turns (role and text); the root has none. With
    ``stride`` conversations are first rebuilt on shared beginnings (``shared_heads``).
    Columns: conv_id (smallest member), depth, parent_conv_id, n_convs (members),
    n_children, n_leaves (childless nodes of the subtree), saved_tokens (over the subtree:
    words of each node's last text for each member but one), ends_sha256 (members that end
    here, ascending).

    NULL roles and texts are empty; rows without conv_id are ignored; a NULL turn comes
    first, turns of one number are ordered by a hash of role and text, repeated rows are
    repeated turns; an empty table gives no rows; further columns are ignored.
    """
    turns = numbered_turns(conversations)
    convs, turns = shared_heads(turns, stride, most) if stride else as_they_are(turns)
    members = stage(with_prefixes(turns))
    nodes = members.groupBy("depth", "k1", "k2").agg(
        F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"), F.max("words").alias("words"),
        F.max("p1").alias("p1"), F.max("p2").alias("p2"),
    )
    zero = [F.lit(0).cast("long").alias(c) for c in ("depth", "k1", "k2")]
    root = convs.agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs")).where("n_convs > 0").select(
        *zero, "conv_id", "n_convs", F.lit(0).cast("long").alias("words"), *[F.lit(None).cast("long").alias(c) for c in ("p1", "p2")]
    )
    nodes = stage(nodes.withColumn("depth", F.col("depth").cast("long")).unionByName(root))
    above = nodes.select((F.col("depth") + 1).alias("depth"), F.col("k1").alias("p1"), F.col("k2").alias("p2"), F.col("conv_id").alias("parent_conv_id"))
    nodes = stage(nodes.join(above, ["depth", "p1", "p2"], "left"))

    def name(conv_id: str, depth: Column) -> Column:
        return F.concat_ws(".", F.col(conv_id), depth)

    parent = F.when(F.col("depth") > 0, name("parent_conv_id", F.col("depth") - 1))
    named = stage(nodes.select(
        name("conv_id", F.col("depth")).alias("id"), parent.alias("parent"), ((F.col("n_convs") - 1) * F.col("words")).alias("saved_tokens")
    ))
    children = named.where("parent is not null").groupBy("parent").agg(F.count("*").alias("n_children")).withColumnRenamed("parent", "id")
    named = stage(named.join(children, "id", "left").withColumn("n_children", F.coalesce("n_children", F.lit(0).cast("long"))))
    sums = subtree_sums(named.withColumn("n_leaves", (F.col("n_children") == 0).cast("long")), ["n_leaves", "saved_tokens"])
    ends = members.where("ends").select("depth", "k1", "k2", "conv_id")
    ends = ends.withColumn("depth", F.col("depth").cast("long")).unionByName(convs.where("depth = 0").select(*zero, "conv_id"))
    no_ends = hashlib.sha256(b"").hexdigest()
    return (
        nodes.withColumn("id", name("conv_id", F.col("depth")))
        .join(named.select("id", "n_children"), "id").join(sums, "id")
        .join(ends_digests(ends), ["depth", "k1", "k2"], "left")
        .select(
            "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
            F.coalesce("ends_sha256", F.lit(no_ends)).alias("ends_sha256"),
        )
    )
