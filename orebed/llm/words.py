"""Encoding with a public word-level tokenizer, one part of a text at a time.

The vocabulary ends every word at white space, so the ids of a text are those of its
pieces between spaces in order, and those of a piece are the ids of its runs of letters,
digits and other signs. Most of these repeat: each worker keeps the id bytes of those it has
met (a bounded cache) and asks the tokenizers library only for new ones.
"""

from __future__ import annotations

import os
import re
import struct
from functools import lru_cache

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

#: Parts and pieces kept per worker; those met since half of this many new ones came.
CACHED = 600_000
#: Letters whose lower case, composition and class are the same in every library.
_LETTERS = "a-zß-öø-ÿ"
_PLAIN = re.compile("[\n -~À-ÖØ-öø-ÿ]*")
_PARTS = re.compile(f"[{_LETTERS}]+|[0-9]|'(?:[stmd]|re|ve|ll)|[^ \n0-9{_LETTERS}]+")


def _byte_letters() -> dict[int, str]:
    """The printable letter that byte-level vocabularies use for each byte."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}


@lru_cache(maxsize=256)
def _packer(n: int):
    return struct.Struct(f"<{n}I").pack


class PieceCache(dict):
    """Part or piece without spaces and line ends -> its ids as little-endian unsigned 32-bit integers."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        super().__init__({"": b""})
        self.older: dict[str, bytes] = {}
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.tokenize = self.tokenizer.model.tokenize
        self.letters = str.maketrans(_byte_letters())
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]

    def whole(self, text: str) -> bytes:
        ids = self.tokenizer.encode(text, add_special_tokens=False).ids
        return _packer(len(ids))(*ids)

    def parts(self, text: str) -> list[str] | None:
        """The parts of a text whose lower case, parts and byte letters are plain; None for others."""
        if not _PLAIN.fullmatch(text) or ("<|" in text and any(s in text for s in self.special)):
            return None
        return _PARTS.findall(text.lower())

    def __missing__(self, piece: str) -> bytes:
        found = self.older.get(piece)
        if found is None:
            parts = [piece] if piece.isascii() and piece.isalpha() and piece.islower() else self.parts(piece)
            if parts is None:
                found = self.whole(piece)
            elif parts == [piece]:  # the library's model does the merges
                letters = piece if piece.isascii() else piece.encode().decode("latin-1").translate(self.letters)
                ids = [t.id for t in self.tokenize(letters)]
                found = _packer(len(ids))(*ids)
            else:
                found = b"".join(map(self.__getitem__, parts))
        if len(self) > CACHED // 2:
            self.older = dict(self)
            self.clear()
            self[""] = b""
        self[piece] = found
        return found


@lru_cache(maxsize=2)
def pieces(path: str) -> PieceCache:
    """The worker's cache for one tokenizer file."""
    return PieceCache(path)


def forget() -> None:
    """Let go of the worker's caches: for steps that do not encode, in workers that come from one that did."""
    pieces.cache_clear()


def id_bytes(cache: PieceCache, text: str | None) -> bytes:
    """All ids of a text as little-endian unsigned 32-bit integers; none for null."""
    if not text:
        return b""
    parts = cache.parts(text)
    if parts is None:
        parts = text.replace("\n", " ").split(" ")
    return b"".join(map(cache.__getitem__, parts))
