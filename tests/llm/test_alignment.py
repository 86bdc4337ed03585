"""Alignment of two tokenizers against whole encodings, and the fragments' composition."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
import sentencepiece
from tokenizers import Tokenizer

from riskframe.llm import alignment
from riskframe.llm.fragments import ByteLevelIds, Fragment, TwoTokenizers
from riskframe.llm.queries import tokenizer_path

PATHS = tokenizer_path("byte_bpe_50k.json"), tokenizer_path("piece_bpe_32k.model")


def group_text(a, b):
    return f"{','.join(map(str, a))}|{','.join(map(str, b))}".encode()


@pytest.fixture(scope="module")
def two():
    return TwoTokenizers(*PATHS)


def brute(texts):
    """Rows of the contract from whole encodings and byte sets."""
    a_side = Tokenizer.from_file(PATHS[0])
    a_side.encode_special_tokens = True
    b_side = sentencepiece.SentencePieceProcessor(model_file=PATHS[1])
    letters = {chr(b): b for b in [*range(33, 127), *range(161, 173), *range(174, 256)]}
    letters |= {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in letters.values())}
    spelt = lambda ids: [bytes(letters[c] for c in a_side.id_to_token(i)) for i in ids]

    def of_b(i):
        return bytes([int(b_side.id_to_piece(i)[3:5], 16)]) if b_side.is_byte(i) else b_side.id_to_piece(i).replace("▁", " ").encode()

    def ends(parts):
        n, out = 0, []
        for p in parts:
            out.append((n, n := n + len(p)))
        return out

    rows, counts = [], Counter()
    for text in texts:
        a, b = (a_side.encode(" " + text, add_special_tokens=False).ids, b_side.encode(text)) if text else ([], [])
        parts_a, parts_b = spelt(a), [of_b(i) for i in b]
        if not text or not b"".join(parts_a) == (" " + text).encode() == b"".join(parts_b):
            rows.append(([], [], []))
            continue
        at_a, at_b = ends(parts_a), ends(parts_b)
        links = [(x, y) for x, (s, e) in zip(a, at_a) for y, (t, f) in zip(b, at_b) if max(s, t) < min(e, f)]
        both = sorted({e for _, e in at_a} & {e for _, e in at_b})
        groups = [([x for x, (_, e) in zip(a, at_a) if lo < e <= hi], [y for y, (_, e) in zip(b, at_b) if lo < e <= hi]) for lo, hi in zip([0, *both], both)]
        rows.append((links, groups, (a, b)))
        counts.update(links)
    best = Counter()
    for (_, b), n in counts.items():
        best[b] = max(best[b], n)
    out = []
    for links, groups, ids in rows:
        if not groups:
            out.append((0, 0, 0, 0, 0, 0, ""))
            continue
        digest = hashlib.sha256(b";".join(group_text(*g) for g in groups)).hexdigest()
        n_best = sum(counts[x] == best[x[1]] for x in links)
        out.append((len(ids[0]), len(ids[1]), len(groups), len(links), n_best, sum(counts[x] for x in links), digest))
    return out


ODD = [
    " ", "  a  b ", "a▁b", "x  y　z    w", "東京都は 日本 " * 9, "<|endoftext|> <s> </s> <0x41>",
    "tab\there\n\nline \n it's 'so don't  I'LL,", "\U0001F600\U0001F600 करना, था", "aaaa" * 60 + " b", "\x00\x01 \x7f q",
    "".join(chr(c) for c in range(0x20, 0x250)), "uné×÷x ÉTAGE, straße; #tag! 12345 3.14",
]


def test_align(spark, awkward, rows_of):
    rows = [r[1][:2500] for r in rows_of] + ODD
    docs = spark.createDataFrame([(i % 20 or None, t) for i, t in enumerate(rows)], "doc_id long, text string").repartition(3)
    expected = Counter((i % 20 or None, *r) for i, r in enumerate(brute(rows)))
    for chunk, block in ((64, 3000), (1 << 16, 1 << 20)):
        got = alignment.align(docs, *PATHS, chunk_bytes=chunk, block_bytes=block)
        assert Counter(tuple(r) for r in got.collect()) == expected


def test_any_cut_gives_the_groups_of_the_whole(two):
    rng = random.Random(2)
    texts = [" " + t for t in ODD if "▁" not in t] + [" " + " ".join(rng.choice(["thering", "uné", "a,b", "it's", "42", "東京"]) for _ in range(60))]
    for text in texts:
        whole = text.encode()
        expected = two.whole(whole)
        for size in (1, 2, 3, 7, 20, 64, 1000):
            state, found = Fragment(), []
            for k, (lo, start, end, hi) in enumerate(two.cuts(whole, size)):
                piece, closed = two.fragment(whole[lo:hi], start - lo, end - lo, k == 0)
                state, group = state.then(piece) if k else (piece, None)
                found += [two.closed(*map(np.array, group))] if group else []
                found += [closed] if closed[0] else []
            assert not (state.suf_a or state.suf_b or state.pre_a or state.pre_b)
            assert b";".join(f[0] for f in found) == expected[0], (text, size)
            assert np.concatenate([f[1] for f in found]).tolist() == expected[1].tolist()


def test_pieces_of_plain_texts_equal_the_tokenizer(two):
    rng = random.Random(5)
    parts = [" ", "  ", "\n", "\t ", "\r\n", "a", "Word", "it's", "'LL", "'ll", "12", ",", "--", "é", "Ñu", "×", "\x0b", "\x1c", "\x7f", "'", "x"]
    for _ in range(2000):
        text = " " + "".join(rng.choice(parts) for _ in range(rng.randrange(12)))
        assert two.ids(text.encode())[0].tolist() == two.a.encode(text, add_special_tokens=False).ids, text


def test_composition_is_associative():
    rng = random.Random(1)

    def some(n):
        return [rng.randrange(9) for _ in range(rng.randrange(1, n))]

    for _ in range(300):
        x, y, z = (Fragment(True, some(3), some(3), some(3), some(3)) if rng.random() < 0.5 else Fragment(False, some(3), some(3)) for _ in range(3))
        (xy, g1), (yz, g2) = x.then(y), y.then(z)
        left, g3 = xy.then(z)
        right, g4 = x.then(yz)
        assert left == right
        assert [g for g in (g1, g3) if g] == [g for g in (g4, g2) if g]


def test_no_rows(empty):
    assert alignment.align(empty, *PATHS).isEmpty()


def test_pieces_of_a_large_vocabulary_are_encoded_once():
    class Model:
        calls = 0

        def tokenize(self, piece):
            Model.calls += 1
            return []

    pieces = ByteLevelIds(Model())
    for _ in range(3):
        for at in range(0, 380_000, 20_000):
            pieces.encode(b" ".join(b"%x" % i for i in range(at, at + 20_000)).translate(bytes.maketrans(b"0123456789", b"ghijklmnop")))
    assert Model.calls <= 380_000
