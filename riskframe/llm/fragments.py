"""Aligned fragments of two tokenizations: byte ranges, their closed groups, and their composition.

Offsets where tokens of both sides end cut a text into groups. What a byte range knows of
them is a fragment: the tokens up to its first common end (open prefix), the groups
between common ends (closed), and the tokens after the last one (open suffix); without a
common end all its tokens are open. Fragments of neighbouring ranges compose, in any
order of composition, to the fragment of the joint range: suffix and prefix that meet
close a group. A token belongs to the range in which it ends.
"""

from __future__ import annotations

import os
import re
import struct
from dataclasses import dataclass, field

import numpy as np

from riskframe.llm.tokens import BYTE_LETTERS

# White space in the sense of the byte-level vocabularies' pattern, as ends and starts of UTF-8 sequences; controls count too.
_SPACES = [rb"[\x00-\x20\x7f]", rb"\xc2[\x85\xa0]", rb"\xe1\x9a\x80", rb"\xe1\xa0\x8e", rb"\xe2\x80[\x80-\x8a\xa8\xa9\xaf]", rb"\xe2\x81\x9f", rb"\xe3\x80\x80"]
#: A space between two other characters.
_CUT = re.compile(b"(?<=.)" + b"".join(b"(?<!%s)" % s for s in _SPACES) + b" (?!%s|\\Z)" % b"|".join(_SPACES), re.DOTALL)

# Texts of ASCII and Latin-1 letters, and the pieces into which the byte-level side's pattern splits them (fixed values).
_PLAIN = re.compile(rb"(?:[\x00-\x1b\x20-\x7f]|\xc3[\x80-\x96\x98-\xb6\xb8-\xbf])*")
_PIECES = re.compile(
    rb"'s|'t|'re|'ve|'m|'ll|'d| ?(?:[A-Za-z]|\xc3[\x80-\xbf])+| ?[0-9]+| ?[^\sA-Za-z0-9\xc3]+|\s+(?!\S)|\s+"
)
#: Distinct pieces in each of the two generations that a worker remembers, and the longest of them.
MEMORY, LONGEST = 400_000, 64


class ByteLevelIds(dict):
    """Ids of the byte-level side's pieces, remembered, as little-endian 64-bit integers."""

    def __init__(self, model):
        super().__init__()
        self.tokenize, self.older = model.tokenize, {}

    def __missing__(self, piece: bytes) -> bytes:
        ids = self.older.get(piece)
        if ids is None:
            found = [t.id for t in self.tokenize(piece.decode("latin-1").translate(BYTE_LETTERS))]
            ids = struct.pack(f"<{len(found)}q", *found)
        if len(piece) <= LONGEST:
            self[piece] = ids
        return ids

    def encode(self, text: bytes) -> np.ndarray:
        if len(self) > MEMORY:
            self.older = dict(self)
            self.clear()
        return np.frombuffer(b"".join(map(self.__getitem__, _PIECES.findall(text))), "<i8")


@dataclass
class Fragment:
    """Token ids of the open ends; ``cut`` tells whether the range holds a common end."""

    cut: bool = False
    pre_a: list[int] = field(default_factory=list)
    pre_b: list[int] = field(default_factory=list)
    suf_a: list[int] = field(default_factory=list)
    suf_b: list[int] = field(default_factory=list)

    def then(self, other: Fragment) -> tuple[Fragment, tuple[list[int], list[int]] | None]:
        """The joint fragment, and the tokens of the group that closes between them, if one does.

        Tokens of a range without common end are in ``pre_a`` and ``pre_b``.
        """
        if not self.cut:
            joint = Fragment(other.cut, self.pre_a + other.pre_a, self.pre_b + other.pre_b, other.suf_a, other.suf_b)
            return joint, None
        meet = (self.suf_a + other.pre_a, self.suf_b + other.pre_b)
        if not other.cut:
            return Fragment(True, self.pre_a, self.pre_b, *meet), None
        return Fragment(True, self.pre_a, self.pre_b, other.suf_a, other.suf_b), meet if meet[0] else None


class TwoTokenizers:
    """Both tokenizations of texts, each with a space before it.

    Neither side joins across a space between two other characters: the byte-level side
    starts a piece there, and the pieces of the other side hold spaces at their start only.
    So a text may be encoded in parts that start at such spaces. Where a model does not
    promise that (``safe`` is False), texts are encoded whole.
    """

    def __init__(self, path_a: str, path_b: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark gives the cores out
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        byte_of = {c: bytes([b]) for b, c in BYTE_LETTERS.items()}
        entries = [self.a.id_to_token(i) or "" for i in range(self.a.get_vocab_size(with_added_tokens=True))]
        self.bytes_a = [b"".join(byte_of.get(c, c.encode()) for c in e) for e in entries]
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.bytes_b = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]
        self.size_a, self.size_b = (np.array([len(x) for x in e], np.int64) for e in (self.bytes_a, self.bytes_b))
        # Ids as text, with what follows them inside a group and at its end.
        self.text_a = [np.array([f"{i}{mark}" for i in range(len(entries))], object) for mark in ",|"]
        self.text_b = [np.array([f"{i}{mark}" for i in range(len(pieces))], object) for mark in ",;"]
        pre = repr(self.a.pre_tokenizer)
        self.safe = (
            self.a.normalizer is None and "ByteLevel" in pre and "use_regex=True" in pre and "add_prefix_space=False" in pre
            and all(self.a.token_to_id(c) is not None for c in byte_of)
            and any(self.b.is_byte(i) for i in range(min(300, len(pieces)))) and self.b.normalize("x  y ") == "▁x▁▁y▁"
            and not any("▁" in p.lstrip("▁") for p in pieces)
        )
        self.pieces = ByteLevelIds(self.a.model)

    def keeps(self, text: str) -> bool:
        """Whether the second side's pieces spell the text after one space."""
        return self.b.normalize(text).replace("▁", " ") == " " + text

    def ids(self, part: bytes) -> tuple[np.ndarray, np.ndarray]:
        """Ids of both sides for bytes that begin with a space."""
        if self.safe and _PLAIN.fullmatch(part):
            a = self.pieces.encode(part)
        else:
            a = np.array(self.a.encode_batch_fast([part.decode()], add_special_tokens=False)[0].ids, np.int64)
        return a, np.array(self.b.encode(part[1:].decode()), np.int64)

    def spelt(self, part: bytes, a: np.ndarray, b: np.ndarray) -> bool:
        """Whether the tokens' bytes are the part; the byte-level side of a safe pair always spells its text."""
        if self.safe:
            return self.keeps(part[1:].decode())
        return b"".join([self.bytes_a[x] for x in a]) == part == b"".join([self.bytes_b[x] for x in b])

    def closed(self, a: np.ndarray, b: np.ndarray) -> tuple[bytes, np.ndarray, int]:
        """Groups as text, links (a << 32 | b), and tokens of the first side, of tokens that span the same bytes."""
        if not len(a) or not len(b):
            return b"", np.empty(0, np.uint64), 0
        end_a, end_b = np.cumsum(self.size_a[a]), np.cumsum(self.size_b[b])
        at = np.searchsorted(end_a, end_b)
        both_b = end_a[at] == end_b
        both_a = np.zeros(len(a), bool)
        both_a[at[both_b]] = True
        # Between two ends of either side one token of each side overlaps.
        ends = np.sort(np.concatenate([end_a, end_b[~both_b]]))
        links = a[np.searchsorted(end_a, ends)].astype(np.uint64) << np.uint64(32) | b[np.searchsorted(end_b, ends)].astype(np.uint64)
        # Each group's first side, then its second: a token stands after its side's earlier
        # tokens and the other side's tokens of earlier groups, or of its own group too.
        upto_a, upto_b = np.flatnonzero(both_a) + 1, np.flatnonzero(both_b) + 1
        group_a, group_b = np.cumsum(both_a) - both_a, np.cumsum(both_b) - both_b
        text = np.empty(len(a) + len(b), object)
        text[np.arange(len(a)) + np.append(0, upto_b)[group_a]] = np.where(both_a, self.text_a[1][a], self.text_a[0][a])
        text[np.arange(len(b)) + upto_a[group_b]] = np.where(both_b, self.text_b[1][b], self.text_b[0][b])
        return "".join(text.tolist())[:-1].encode(), links, len(a)

    def whole(self, text: bytes) -> tuple[bytes, np.ndarray, int] | None:
        """Groups, links and tokens of a whole text after its space; None if the tokens do not spell it."""
        a, b = self.ids(text)
        return self.closed(a, b) if self.spelt(text, a, b) else None

    def cuts(self, text: bytes, size: int) -> list[tuple[int, int, int, int]]:
        """(from, start, end, to) of byte ranges of about ``size``: tokens that end in (start, end] need bytes [from, to).

        Ranges may start anywhere; a bound is left out where the stretch between spaces
        around it is longer than ``size``, so that no stretch is encoded more than twice.
        """
        places = [(0, 0, 0)]
        safe = np.array([0, *(m.start() for m in _CUT.finditer(text)), len(text)] if self.safe else [0, len(text)])
        for at in range(size, len(text), size):
            k = int(np.searchsorted(safe, at, side="right"))
            if k < len(safe) and safe[k] - safe[k - 1] <= size:
                places.append((at, int(safe[k - 1]), int(safe[k] if safe[k - 1] < at else at)))
        places.append((len(text), len(text), len(text)))
        return [(lo, s, e, hi) for (s, lo, _), (e, _, hi) in zip(places, places[1:])]

    def fragment(self, part: bytes, start: int, end: int, first: bool) -> tuple[Fragment, tuple[bytes, np.ndarray, int]]:
        """The fragment of bytes (start, end] of ``part``, which starts and ends between stretches, and its closed groups.

        ``first`` tells that the range starts the text, which is a common end.
        """
        a, b = self.ids(part)
        end_a, end_b = np.cumsum(self.size_a[a]), np.cumsum(self.size_b[b])
        both = np.append(0, np.intersect1d(end_a, end_b, assume_unique=True))
        both = both[(both >= start) & (both <= end)]
        own_a, own_b = (end_a > start) & (end_a <= end), (end_b > start) & (end_b <= end)
        a, b, end_a, end_b = a[own_a], b[own_b], end_a[own_a], end_b[own_b]
        if not len(both):
            return Fragment(first, a.tolist(), b.tolist()), self.closed(a[:0], b[:0])
        lo, hi = both[0], both[-1]
        state = Fragment(
            True, a[end_a <= lo].tolist(), b[end_b <= lo].tolist(), a[end_a > hi].tolist(), b[end_b > hi].tolist()
        )
        return state, self.closed(a[(end_a > lo) & (end_a <= hi)], b[(end_b > lo) & (end_b <= hi)])
