"""Token ids of whole texts by a public tokenizer, word by word through a bounded cache.

The tokenizer drops white space and cuts there, so the ids of a text are those of
its pieces between ASCII white space.  Pieces repeat, texts do not: a task encodes
each distinct piece once.  Pieces of Latin letters with trailing punctuation, which
the tokenizer cuts into these two parts, go to the library's model directly; all
others take the library's whole path.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Callable

#: More pieces than this are forgotten together.
CACHE_PIECES = 400_000
#: Longer pieces are not kept.
CACHE_BYTES = 64

_PLAIN = re.compile("([a-zA-ZÀ-ÖØ-öø-ſ]*)([!-/:-@\\[-`{-~]*)")


def _byte_letters() -> dict[int, str]:
    """Byte-level alphabet: printable Latin-1 bytes stand for themselves, the others follow from U+0100."""
    kept = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in kept]
    return {b: chr(b) for b in kept} | {b: chr(256 + i) for i, b in enumerate(rest)}


class PieceEncoder:
    """``encode(text) -> bytes``: the ids as little-endian unsigned 32-bit numbers."""

    def __init__(self, path: str):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.letters = _byte_letters()
        self.parts: dict[str, bytes] = {"": b""}
        self.pieces: dict[bytes, bytes] = {}
        import json

        plan = json.loads(self.tokenizer.to_str())
        kinds = [x["type"] for x in plan["normalizer"]["normalizers"]] if plan.get("normalizer") else []
        cuts = [x["type"] for x in plan["pre_tokenizer"].get("pretokenizers", [])] if plan.get("pre_tokenizer") else []
        if kinds != ["NFC", "Replace", "Lowercase"] or cuts != ["Split", "ByteLevel"]:
            raise ValueError(f"{path}: only tokenizers that drop white space and lower-case can be cut at white space")

    def _part(self, word: str) -> bytes:
        ids = self.parts.get(word)
        if ids is None:
            spelled = word if word.isascii() else "".join(self.letters[b] for b in word.encode())
            ids = b"".join(t.id.to_bytes(4, "little") for t in self.tokenizer.model.tokenize(spelled))
            if len(self.parts) > CACHE_PIECES:
                self.parts = {"": b""}
            self.parts[word] = ids
        return ids

    def _piece(self, piece: bytes) -> bytes:
        text = piece.decode()
        plain = _PLAIN.fullmatch(text)
        if plain:
            word = plain[1].lower() if text.isascii() else "".join(c.lower() for c in plain[1])
            if text.isascii() or unicodedata.is_normalized("NFC", text) and _PLAIN.fullmatch(word):
                return self._part(word) + self._part(plain[2])
        ids = self.tokenizer.encode(text, add_special_tokens=False).ids
        return b"".join(i.to_bytes(4, "little") for i in ids)

    def encode(self, text: bytes) -> bytes:
        pieces = text.split()
        try:
            return b"".join(map(self.pieces.__getitem__, pieces))
        except KeyError:
            pass
        if len(self.pieces) > CACHE_PIECES:
            self.pieces = {}
        long: dict[bytes, bytes] = {}
        for piece in set(pieces).difference(self.pieces):
            (self.pieces if len(piece) <= CACHE_BYTES else long)[piece] = self._piece(piece)
        if not long:
            return b"".join(map(self.pieces.__getitem__, pieces))
        return b"".join([self.pieces.get(p) or long.get(p, b"") for p in pieces])


def encoder(path: str) -> Callable[[bytes], bytes]:
    """Ids of a text as little-endian 32-bit numbers, by the library of the file's kind."""
    if path.endswith(".json"):
        return PieceEncoder(path).encode
    import numpy as np
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    return lambda text: np.array(model.encode(text.decode()), "<u4").tobytes()
