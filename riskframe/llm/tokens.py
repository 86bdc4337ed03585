"""Token ids of whole texts, word by word, each distinct word encoded once per worker."""

from __future__ import annotations

import json
import os
import re
import struct

import numpy as np

#: Distinct words in each of the two generations that a worker remembers.
MEMORY = 300_000
#: Longer words are encoded each time, so that memory stays bounded.
LONGEST = 64

#: Letters whose lower case and normal form need no context: ASCII and Latin-1.
_LETTERS = rb"(?:[a-z]|\xc3[\x80-\x96\x98-\xb6\xb8-\xbf])+"
#: ASCII marks but the apostrophe.
_MARKS = rb"[!-&(-/:-@\[-`{-~]+"
_LETTER_WORD = re.compile(_LETTERS)
_LETTERS_MARKS = re.compile(rb"(%s)(%s)" % (_LETTERS, _MARKS))
#: The pre-tokenizer under which a run of letters is a piece of its own.
_LETTER_RUNS = "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"


def _byte_letters() -> dict[int, str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = [b for b in range(256) if b not in set(plain)]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(other)}


BYTE_LETTERS = _byte_letters()


class WordEncoder(dict):
    """Ids of texts for tokenizers that lower-case, drop white space and never join pieces across it.

    A text is cut at ASCII white space; each word's ids are looked up by its bytes, as
    little-endian unsigned 32-bit integers, and joined. Where the tokenizer makes each run
    of letters a piece, new words of letters go straight to its model, and marks after
    them are words of their own. ASCII letters are lower-cased first, unless the text has
    combining marks, with which the case may matter. A text that holds ``<|``, and so may
    hold a special token, is encoded whole. Words are remembered in two generations:
    when the younger is full, it becomes the older one, so frequent words stay.
    """

    def __init__(self, path: str):
        super().__init__()
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark gives the cores out
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        steps = json.loads(self.tokenizer.to_str())["pre_tokenizer"] or {}
        steps = steps.get("pretokenizers", [steps])
        self.letter_runs = any(s.get("pattern", {}).get("Regex") == _LETTER_RUNS for s in steps)
        self._tokenize = self.tokenizer.model.tokenize
        self.older: dict[bytes, bytes] = {}

    @staticmethod
    def _pack(*ids: int) -> bytes:
        return struct.pack(f"<{len(ids)}I", *ids)

    def whole(self, text: bytes) -> bytes:
        ids = self.tokenizer.encode(text.decode(), add_special_tokens=False).ids
        return np.array(ids, "<u4").tobytes()

    def _new(self, word: bytes) -> bytes:
        if self.letter_runs:
            if word.isalpha():  # ASCII letters
                return self._pack(*[t.id for t in self._tokenize(word.lower().decode())])
            if _LETTER_WORD.fullmatch(word):
                letters = word.decode().lower().encode().decode("latin-1").translate(BYTE_LETTERS)
                return self._pack(*[t.id for t in self._tokenize(letters)])
            if parts := _LETTERS_MARKS.fullmatch(word):
                return self[parts[1]] + self[parts[2]]
        return self.whole(word)

    def __missing__(self, word: bytes) -> bytes:
        if len(word) > LONGEST:
            return self._new(word)
        ids = self.older.get(word)
        self[word] = ids = self._new(word) if ids is None else ids
        return ids

    def encode(self, text: bytes) -> bytes:
        """Ids of a UTF-8 text."""
        if b"<|" in text:
            return self.whole(text)
        if len(self) > MEMORY:
            self.older = dict(self)
            self.clear()
        if b"\xcc" not in text and b"\xcd" not in text:
            text = text.lower()
        return b"".join(map(self.__getitem__, text.split()))


_encoders: dict[str, WordEncoder] = {}


def encoder(path: str) -> WordEncoder:
    """This worker's encoder for a tokenizer file."""
    if path not in _encoders:
        _encoders[path] = WordEncoder(path)
    return _encoders[path]
