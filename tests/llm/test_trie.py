"""The conversation trie against plain loops, with deep chains and awkward rows."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from riskframe.llm import trie

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "conv_id long, turn long, role string, text string, depth int, id string"


def brute(rows, stride=20, most=4):
    """Rows of the contract from (conv_id, turn, role, text)."""
    convs = defaultdict(list)
    for conv_id, turn, role, text in rows:
        if conv_id is not None:
            role, text = role or "", text or ""
            digest = hashlib.sha256(f"{len(role)}:{role}{text}".encode()).hexdigest()
            convs[conv_id].append(((turn is not None, turn or 0, digest), (role, text)))
    convs = {c: [t for _, t in sorted(ts)] for c, ts in convs.items()}
    built = dict(convs)
    if stride:
        for c, own in convs.items():
            h = zlib.crc32(str(c).encode()) % most
            built[c] = convs.get(c - int(math.fmod(c, stride)), [])[:h] + own[h:]
    members = defaultdict(list)
    for c in sorted(built):
        for d in range(len(built[c]) + 1):
            members[tuple(built[c][:d])].append(c)
    children = Counter(p[:-1] for p in members if p)
    leaves, saved = Counter(), Counter()
    for prefix, ids in members.items():
        words = len(WORD.findall(prefix[-1][1])) if prefix else 0
        for d in range(len(prefix) + 1):
            leaves[prefix[:d]] += prefix not in children
            saved[prefix[:d]] += (len(ids) - 1) * words
    out = []
    for prefix, ids in members.items():
        ends = ",".join(str(c) for c in ids if len(built[c]) == len(prefix))
        parent = members[prefix[:-1]][0] if prefix else None
        digest = hashlib.sha256(ends.encode()).hexdigest()
        out.append((ids[0], len(prefix), parent, len(ids), children[prefix], leaves[prefix], saved[prefix], digest))
    return Counter(out)


def conversations(rng, n, most=6):
    rows = []
    for c in range(n):
        for t in range(rng.randrange(most)):
            rows.append((c, t, rng.choice(["user", "assistant", None]), rng.choice(["hello there", "yes", "no  way", "", None, "a b c"])))
    return rows


@pytest.mark.parametrize("stride", [20, None])
def test_trie(spark, stride):
    rng = random.Random(3)
    rows = conversations(rng, 150)
    # a deep chain, copies, equal and missing turns, missing ids, repeated rows, ids without a head
    rows += [(40, t, "user", "deep") for t in range(90)] + [(41, t, "user", "deep") for t in range(70)]
    rows += [(c, t, "user", f"copy {t}") for c in range(300, 340) for t in range(5)]
    rows += [(500, None, "user", "first"), (500, 0, "a", "x"), (500, 0, "b", "y"), (500, 0, "b", "y"), (None, 1, "user", "x"), (501, 3, None, None)]
    rows += [(25, 1, "user", "é　x y"), (987654321987, 0, "user", "far"), (-7, 2, "user", "below"), (-20, 0, "u", "v")]
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], SCHEMA).repartition(5)
    got = trie.prefix_trie(df, stride)
    assert got.columns == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    assert Counter(map(tuple, got.collect())) == brute(rows, stride)


def test_no_rows(spark):
    assert trie.prefix_trie(spark.createDataFrame([], SCHEMA), 20).isEmpty()


def test_running_sums_of_a_key_over_many_tasks(spark):
    rows = spark.range(20_000).select((F.col("id") % 3 == 0).cast("long").alias("key"), "id", (F.col("id") % 7).alias("x"))
    got = trie.running(rows.repartition(4), "key", "id", ["x"]).orderBy("id").collect()
    before = Counter()
    for r in got:
        assert r.before_x == before[r.key]
        before[r.key] += r.x


def test_subtree_sums_of_random_trees(spark):
    rng = random.Random(9)
    for shape in (lambda i: rng.randrange(i), lambda i: max(0, i - rng.randrange(1, 4)), lambda i: i - 1 if i % 40 else 0):
        parent = [None, *(shape(i) for i in range(1, 400))]
        value = [rng.randrange(10) for _ in parent]
        total = list(value)
        for i in range(len(parent) - 1, 0, -1):
            total[parent[i]] += total[i]
        nodes = spark.createDataFrame([(str(i), None if p is None else str(p), v) for i, (p, v) in enumerate(zip(parent, value))], "id string, parent string, v long")
        assert {int(r.id): r.v for r in trie.subtree_sums(nodes, ["v"]).collect()} == dict(enumerate(total))


def test_ids_of_one_node_over_many_pieces(spark):
    ids = list(range(0, 30_000, 3))
    ends = spark.createDataFrame([(2, 5, 6, i) for i in ids] + [(3, 5, 6, 1)], "depth long, k1 long, k2 long, conv_id long").repartition(6)
    got = {r.depth: r.ends_sha256 for r in trie.ends_digests(ends).collect()}
    assert got == {2: hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), 3: hashlib.sha256(b"1").hexdigest()}
