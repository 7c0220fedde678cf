"""Token ids of whole texts, by a public tokenizer file given as a parameter.

The ids are those that the ``tokenizers`` library gives for the whole text.
Byte-level BPE cuts a text before it merges, and never across the start of a
run of white space. So a text may be cut there into pieces (white space and
the characters after it): the ids of a piece seen before are looked up, and a
new piece is merged by ``tiktoken`` over the vocabulary of the same file,
which is ten times as fast for one word. Texts where that would not hold
(white space other than blanks and line ends, markers of special tokens) and
tokenizers of another kind are encoded whole by ``tokenizers``.
"""

from __future__ import annotations

import json
import os
import re
import sys
from array import array
from functools import partial

import numpy as np

#: pieces that a worker remembers, about 200 bytes each; a full memory starts anew
REMEMBERED = 1_000_000
#: id that ends a document
END = 0

_OTHER_SPACE = [c for c in map(chr, range(sys.maxunicode + 1)) if c.isspace() and c not in " \n"]
_RUN = ("  ", " \n", "\n ", "\n\n")
_PIECE = re.compile(r"[ \n]*[^ \n]+|[ \n]+")


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _byte_of() -> dict[str, int]:
    """The character that byte-level vocabularies write for each byte, backwards."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(others)}


def _merger(path: str):
    """A fast encoder of pieces for a plain byte-level BPE file, else None."""
    with open(path, encoding="utf-8") as file:
        held = json.load(file)
    cut, model = held.get("pre_tokenizer") or {}, held["model"]
    if model.get("type") != "BPE" or cut.get("type") != "ByteLevel" or cut.get("add_prefix_space") or held.get("normalizer"):
        return None
    import public_tokenizers
    import tiktoken

    byte_of, special = _byte_of(), {t["id"] for t in held.get("added_tokens", ())}
    ranks = {bytes(map(byte_of.__getitem__, t)): i for t, i in model["vocab"].items() if i not in special}
    coding = tiktoken.Encoding("file", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    return coding.encode_ordinary


class _Memory(dict):
    """Piece without its blank -> its ids as packed numbers."""

    def __init__(self, merge, pack):
        super().__init__()
        self.merge, self.pack = merge, pack

    def __missing__(self, piece: str) -> bytes:
        if len(self) >= REMEMBERED:
            self.clear()
        ids = self[piece] = self.pack(self.merge(piece if piece[:1] == "\n" else " " + piece)).tobytes()
        return ids


class Encoder:
    """Ids of texts as packed little-endian numbers of type ``dtype``."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        self.dtype = np.dtype("<u2" if self._tokenizer.get_vocab_size() < 1 << 16 else "<u4")
        self._special = [t.content for t in self._tokenizer.get_added_tokens_decoder().values()]
        self._merge = _merger(path)
        self._pack = partial(array, "H" if self.dtype.itemsize == 2 else "I")
        self._memory = _Memory(self._merge, self._pack)

    def whole(self, text: str) -> bytes:
        """Ids by the library alone."""
        return np.array(self._tokenizer.encode(text, add_special_tokens=False).ids, self.dtype).tobytes()

    def packed(self, text: str | None) -> bytes:
        if not text:
            return b""
        if not self._merge or any(s in text for s in _OTHER_SPACE) or any(s in text for s in self._special):
            return self.whole(text)
        memory = self._memory
        if not any(r in text for r in _RUN) and text[0] not in " \n":
            # one blank or line end between pieces: only the first has none before it
            first, *rest = text.replace("\n", " \n").split(" ")
            return self._new(first) + b"".join(map(memory.__getitem__, rest))
        pieces = _PIECE.findall(text)
        return b"".join(memory[p[1:]] if p[0] == " " and p[1:2] not in ("", " ", "\n") else self._new(p) for p in pieces)

    def _new(self, piece: str) -> bytes:
        return self._pack(self._merge(piece)).tobytes()

    def ids(self, text: str | None) -> np.ndarray:
        return np.frombuffer(self.packed(text), self.dtype)
