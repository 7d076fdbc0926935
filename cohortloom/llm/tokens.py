"""Ids of a byte-level BPE tokenizer for whole texts, by way of a cache of words.

The tokenizer's pattern lets a match hold a space only at its start or in a run of
white space that nothing else follows. So it always begins a match at a space before a
non-space, and what stands on either side is encoded alone. A text is cut at these places
only; the pieces recur, and the tokenizer encodes each new one once per worker and cache.
"""

from __future__ import annotations

import os
import re
import struct
from collections.abc import Sequence
from functools import lru_cache

# Spark runs a task per core; threads of the tokenizer only get in their way.
os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

from tokenizers import Tokenizer  # noqa: E402

# Python's white space holds that of the tokenizer, so a cut is never made too often.
BLANK_RUN = re.compile(r" (?=\s|\Z)")
CUT = re.compile(r" (?=\S)")

# The tokenizer's pattern on the characters below U+0250 but control characters, where
# letters, numbers and white space can be told by ranges.
LETTER, NUMBER, BLANK = "A-Za-zªµºÀ-ÖØ-öø-ɏ", "0-9²³¹¼-¾", "\\t\\n\\r \xa0"
NEAR = re.compile("[\\t\\n\\r -~\xa0-ɏ]*")
MATCHES = re.compile(
    f"'(?:s|t|re|ve|m|ll|d)| ?[{LETTER}]+| ?[{NUMBER}]+| ?[^{BLANK}{LETTER}{NUMBER}]+|[{BLANK}]+(?![^{BLANK}])|[{BLANK}]+")
WORD = re.compile(f"[{LETTER}]+")

#: Pieces kept at most, of about 250 bytes each; then the cache starts anew.
CACHE_PIECES = 800_000
#: Longer pieces are encoded but not kept.
CACHE_CHARS = 48


def byte_letters() -> dict[int, str]:
    """The letter by which byte-level tokenizers write each byte: itself if it can be
    seen in Latin-1, and otherwise one beyond, in the order of the bytes."""
    seen = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in seen]
    return {b: chr(b) for b in seen} | {b: chr(256 + k) for k, b in enumerate(rest)}


class _Pieces(dict):
    """Ids by piece, the space before it left out. The library encodes what is new."""

    def __init__(self, tokenizer: Tokenizer):
        super().__init__()
        self.tokenizer, self.model = tokenizer, tokenizer.model
        self.letters = byte_letters()
        self.blank = self.letters[32]
        self.matches: dict[str, list[int]] = {}

    def _match(self, text: str) -> list[int]:
        if text.isascii() and text.isprintable():
            text = text.replace(" ", self.blank)
        else:
            text = text.encode().decode("latin-1").translate(self.letters)
        return [t.id for t in self.model.tokenize(text)]

    def __missing__(self, piece: str) -> bytes:
        if len(piece) > CACHE_CHARS:
            return packed(self.tokenizer.encode(" " + piece, add_special_tokens=False).ids)
        if WORD.fullmatch(piece):
            ids = self._match(" " + piece)
        elif NEAR.fullmatch(piece):
            ids = []
            for match in MATCHES.findall(" " + piece):
                known = self.matches.get(match)
                if known is None:
                    known = self._match(match)
                    if len(match) < 4:
                        self.matches[match] = known
                ids += known
        else:
            ids = self.tokenizer.encode(" " + piece, add_special_tokens=False).ids
        out = self[piece] = packed(ids)
        return out


def packed(ids: Sequence[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


class PieceEncoder:
    """Ids as little-endian unsigned 32-bit integers, equal to those of the tokenizer."""

    def __init__(self, path: str, cache_pieces: int | None = None):
        self.cache_pieces = CACHE_PIECES if cache_pieces is None else cache_pieces
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        added = self.tokenizer.get_added_tokens_decoder()
        self.special = {t.content: int(i).to_bytes(4, "little") for i, t in added.items()}
        self.specials = re.compile("(" + "|".join(map(re.escape, self.special)) + ")") if self.special else None
        self.cache = _Pieces(self.tokenizer)

    def _plain(self, text: str) -> bytes:
        if not text:
            return b""
        head, *words = CUT.split(text) if BLANK_RUN.search(text) else text.split(" ")
        first = packed(self.tokenizer.encode(head, add_special_tokens=False).ids) if head else b""
        if len(self.cache) > self.cache_pieces:
            self.cache.clear()
            self.cache.matches.clear()
        return first + b"".join(map(self.cache.__getitem__, words))

    def encode(self, text: str) -> bytes:
        if self.specials is None or not self.specials.search(text):
            return self._plain(text)
        return b"".join(self.special.get(part) or self._plain(part) for part in self.specials.split(text))


@lru_cache(maxsize=2)
def piece_encoder(path: str, cache_pieces: int | None = None) -> PieceEncoder:
    """One encoder per worker process, tokenizer and size of cache."""
    return PieceEncoder(path, cache_pieces)
