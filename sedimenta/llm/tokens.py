"""Ids of a byte-level BPE tokenizer, with a memory of chunks already encoded.

A text is cut before each single space; no pre-token of this tokenizer reaches over such a cut, so the
ids of the chunks are the ids of the text. Texts in which blanks stand on both sides of a space, or
which hold the string of a special token, are encoded whole.
"""

from __future__ import annotations

import json
import re
from array import array
from functools import cached_property, lru_cache

#: Chunks remembered per worker process; beyond it the memory starts anew. It bounds memory only.
MEMORY = 200_000
_SPACE_IN_BLANKS = re.compile(r"\s\x20\s|\s\x20\Z")
# Fixed value: how the tokenizer cuts a text into pre-tokens.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def _byte_of_char() -> dict[str, int]:
    """The vocabulary writes bytes as characters: printable ones as themselves, the others from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


class Encoder:
    """``packed(text)`` gives the ids as little-endian 32-bit numbers."""

    def __init__(self, path: str) -> None:
        import tiktoken

        with open(path, encoding="utf-8") as file:
            described = json.load(file)
        self.special = [t["content"] for t in described.get("added_tokens", ())]
        of_char = _byte_of_char()
        ranks = {
            bytes(of_char[c] for c in token): rank
            for token, rank in described["model"]["vocab"].items()
            if token not in self.special
        }
        self.fast = tiktoken.Encoding("bytes", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.path = path
        self.plain, self.spaced = _Memory(self, ""), _Memory(self, " ")

    @cached_property
    def exact(self):  # noqa: ANN201
        """The tokenizer library's own; only texts with a special token's string need it."""
        from tokenizers import Tokenizer

        return Tokenizer.from_file(self.path)

    def ids(self, text: str) -> list[int]:
        if any(mark in text for mark in self.special):
            return self.exact.encode(text, add_special_tokens=False).ids
        return self.fast.encode_ordinary(text)

    def packed(self, text: str | None) -> bytes:
        if not text:
            return b""
        if any(mark in text for mark in self.special) or _SPACE_IN_BLANKS.search(text):
            return array("I", self.ids(text)).tobytes()
        if len(self.spaced) > MEMORY:
            self.plain.clear()
            self.spaced.clear()
        first, *rest = text.split(" ")
        return b"".join([self.plain[first] if first else b"", *map(self.spaced.__getitem__, rest)])


class _Memory(dict):
    def __init__(self, encoder: Encoder, before: str) -> None:
        super().__init__()
        self.encode, self.before = encoder.fast.encode_ordinary, before

    def __missing__(self, chunk: str) -> bytes:
        packed = array("I", self.encode(self.before + chunk)).tobytes()
        self[chunk] = packed
        return packed


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """One per worker process and file."""
    return Encoder(path)
