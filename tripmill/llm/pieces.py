"""Encode texts piece by piece, with the library's own merges, inside a task.

Byte-pair merges never cross a pre-token ("piece"), so a text's ids are its pieces' ids in order. A piece
is merged once per worker and looked up afterwards. Texts with characters for which the piece patterns
here and in the library could differ, and texts that spell a special token, go to the library whole.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from functools import lru_cache

import regex
from tokenizers import Tokenizer

#: Below this code point nothing composes, and patterns and lower-casing were compared with the library.
PLAIN_LIMIT = 0x300
#: Misses that a worker keeps before it starts anew: the bound on its memory.
WORKER_CACHE = 400_000


def _members(pattern: str) -> str:
    """A character class body: the plain code points that match."""
    return "".join(re.escape(chr(c)) for c in range(PLAIN_LIMIT) if regex.match(pattern, chr(c)))


LETTERS, NUMBERS, SPACES = _members(r"\p{L}"), _members(r"\p{N}"), _members(r"\s")
OTHER = rf"[^{SPACES}{LETTERS}{NUMBERS}]"
CONTRACTIONS = "'s|'t|'re|'ve|'m|'ll|'d"
#: The two public piece patterns over plain characters (fixed values).
BYTE_PIECES = re.compile(
    rf"{CONTRACTIONS}| ?[{LETTERS}]+| ?[{NUMBERS}]+| ?{OTHER}+|[{SPACES}]+(?![^{SPACES}])|[{SPACES}]+"
)
WORD_PIECES = re.compile(rf"{CONTRACTIONS}|[{LETTERS}]+|[{NUMBERS}]|{OTHER}+")
#: Characters whose lower case is not plain.
_LEAVING = "".join(chr(c) for c in range(PLAIN_LIMIT) if any(ord(x) >= PLAIN_LIMIT for x in chr(c).lower()))
#: Not plain, or the start of a special token.
NOT_PLAIN = re.compile(rf"[^\x00-{chr(PLAIN_LIMIT - 1)}‐-‧]|[{_LEAVING}]|<\|(?:start|end)oftext\|>")


def _byte_alphabet() -> dict[int, str]:
    """The public byte-level alphabet: printable bytes stand for themselves, the rest follow U+00FF."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(printable)]
    return {b: chr(b) for b in printable} | {b: chr(0x100 + n) for n, b in enumerate(rest)}


_ALPHABET = _byte_alphabet()


class PieceTokenizer:
    """A tokenizer file with its piece pattern; ``lower`` for the vocabulary of lower-cased words."""

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.model = self.tokenizer.model
        self.lower = self.tokenizer.normalizer is not None
        self._find = (WORD_PIECES if self.lower else BYTE_PIECES).findall

    def pieces(self, text: str) -> list[str] | None:
        """The text's pieces, or None where only the library decides."""
        if NOT_PLAIN.search(text):
            return None
        return self._find(text.lower() if self.lower else text)

    def piece_ids(self, piece: str) -> list[int]:
        mapped = piece.encode().decode("latin-1").translate(_ALPHABET)
        return [token.id for token in self.model.tokenize(mapped)]

    def text_ids(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids


class WorkerCache(dict):
    """Piece → value; a miss is looked up in the first tier, else computed; emptied when full."""

    def __init__(self, first_tier: dict, compute: Callable[[str], object]):
        super().__init__()
        self.first_tier, self.compute = first_tier, compute

    def __missing__(self, piece: str):
        value = self.first_tier.get(piece)
        if value is None:
            value = self.compute(piece)
        if len(self) >= WORKER_CACHE:
            self.clear()
        self[piece] = value
        return value


@lru_cache(maxsize=4)
def load(path: str) -> PieceTokenizer:
    """One tokenizer for a path in each worker process."""
    return PieceTokenizer(path)
