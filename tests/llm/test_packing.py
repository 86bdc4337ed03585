"""Packing against plain encoding, exact subset sums and the least number of sequences."""

import itertools
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from riskframe.llm import packing
from riskframe.llm.queries import tokenizer_path


def test_fullest_combination_equals_all_subsets():
    rng = random.Random(3)
    for _ in range(200):
        capacity = rng.randrange(8, 40)
        bag = [rng.randrange(1, capacity + 1) for _ in range(rng.randrange(1, 10))]
        longest = max(bag)
        rest = list(bag)
        rest.remove(longest)
        best = max(s for k in range(len(rest) + 1) for c in itertools.combinations(rest, k) if (s := longest + sum(c)) <= capacity)
        found = packing.fullest(dict(Counter(bag)), capacity)
        assert sum(length * n for length, n in found.items()) == best
        assert not found - Counter(bag)


def test_plan_places_every_piece_once():
    rng = random.Random(4)
    counts = Counter(min(64, 1 + int(rng.expovariate(0.05))) for _ in range(3000))
    plan = packing.packing_plan(dict(counts), 64)
    used = defaultdict(list)
    for length, n in counts.items():
        rows = plan[plan[:, 0] == length]
        for rank in range(n):
            _, first, a_sequence, sequence, offset = rows[np.searchsorted(rows[:, 1], rank, side="right") - 1]
            nth = rank - first
            used[sequence + nth // a_sequence].append((offset + nth % a_sequence * length, length))
    for places in used.values():
        places.sort()
        assert [o for o, _ in places] == [0, *itertools.accumulate(n for _, n in places)][:-1]
        assert sum(n for _, n in places) <= 64
    total = sum(length * n for length, n in counts.items())
    assert len(used) <= -(-total // 64) + 1


@pytest.mark.parametrize("capacity", [2048, 50])
def test_pack(awkward, rows_of, capacity):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(tokenizer_path())
    expected = []
    for doc_id, text in rows_of:
        ids = [*tokenizer.encode(text, add_special_tokens=False).ids, 0]
        for piece, at in enumerate(range(0, len(ids), capacity)):
            cut = ids[at : at + capacity]
            expected.append((doc_id, piece, at, len(cut), zlib.crc32(np.array(cut, "<u4").tobytes())))
    pieces = packing.pack(awkward.repartition(4), tokenizer_path(), capacity)
    got = pieces.collect()
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == Counter(expected)
    places = defaultdict(list)
    for r in got:
        places[r.sequence_id].append((r.offset, r.length, bytes(r.ids)))
    for p in places.values():
        p.sort()
        assert [o for o, _, _ in p] == [0, *itertools.accumulate(n for _, n, _ in p)][:-1]
        assert sum(n for _, n, _ in p) <= capacity
    joined = {r.sequence_id: (r.n_tokens, bytes(r.ids)) for r in packing.packed_sequences(pieces).collect()}
    assert joined == {i: (sum(n for _, n, _ in p), b"".join(x for _, _, x in p)) for i, p in places.items()}
    assert len(places) <= -(-sum(r.length for r in got) // capacity) + 1


def test_one_length_and_no_rows(spark, empty):
    docs = spark.createDataFrame([(None, "a b c")] * 500, "doc_id long, text string").repartition(7)
    got = packing.pack(docs, tokenizer_path(), 10, with_ids=False).collect()
    assert Counter(Counter(r.sequence_id for r in got).values()) == Counter({2: 250})
    assert packing.pack(empty, tokenizer_path()).isEmpty()
