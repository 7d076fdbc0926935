"""BPE by dynamic programming over prefixes.

Every prefix of a word has one encoding, and so one last token. Going through the word,
the tokens that end at a place come from an automaton of all tokens; the one that is the
last of the prefix there is the one that can stand behind the last token of what comes
before it. Whether two tokens can stand side by side is decided by replaying the merges
that made them. From the end of the word the stored tokens lead back to the start.

Words recur, so their ids are kept, up to a bound, in each worker.
"""

from __future__ import annotations

import json
import re
import struct
from functools import lru_cache

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from tokenizers import Tokenizer

from .base import identified_texts
from .tokens import BLANK, LETTER, NUMBER, byte_letters, packed

#: Words and pairs of tokens kept at most.
CACHE_WORDS = 400_000
CACHE_PAIRS = 1_000_000
CACHE_CHARS = 48

# Characters whose lower case has ranges for letters, numbers and white space, too.
NEAR = re.compile("[\\t\\n\\r -~\xa0-ſ]*")
#: The pattern of the tokenizer on them.
MATCHES = re.compile(f"'(?:s|t|re|ve|m|ll|d)|[{LETTER}]+|[{NUMBER}]|[^{BLANK}{LETTER}{NUMBER}]+")
NEVER = 1 << 40


class PrefixEncoder:
    """A tokenizer of words with an end-of-word suffix, read from its file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model, suffix = spec["model"], spec["model"]["end_of_word_suffix"]
        if spec["decoder"] is not None or not suffix:
            raise ValueError("only for tokenizers of words with a suffix and without a decoder")
        vocabulary = model["vocab"]
        self.library = Tokenizer.from_file(path)
        self.strings = {i: s for s, i in vocabulary.items()}
        added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.strings |= {i: s for s, i in added.items()}
        self.added = {s: packed([i]) for s, i in added.items()}
        self.added_pattern = re.compile("(" + "|".join(map(re.escape, added)) + ")") if added else None

        # A symbol is one character: a byte's letter, or the letter that ends a word.
        letters = byte_letters()
        self.letters = letters
        self.final = {c: chr(0x1000 + ord(c)) for c in letters.values()}
        symbols = {c: c for c in letters.values()} | {c + suffix: end for c, end in self.final.items()}
        self.left: dict[int, int] = {}
        self.right: dict[int, int] = {}
        self.rank = {vocabulary[s]: -1 for s in symbols}
        self.merged: dict[tuple[int, int], int] = {}
        for rank, (a, b) in enumerate(model["merges"]):
            token = vocabulary[a + b]
            if token in self.rank:
                raise ValueError("two merges make the same token")
            symbols[a + b] = symbols[a] + symbols[b]
            self.left[token], self.right[token] = vocabulary[a], vocabulary[b]
            self.rank[token] = self.merged[vocabulary[a], vocabulary[b]] = rank
        self.length = {vocabulary[s]: len(x) for s, x in symbols.items()}
        self.automaton = ahocorasick.Automaton()
        for s, x in symbols.items():
            self.automaton.add_word(x, (vocabulary[s], len(x)))
        self.automaton.make_automaton()
        self.pairs: dict[tuple[int, int], bool] = {}
        self.words = _Words(self)

    def _side_by_side(self, a: int, b: int) -> bool:
        """Whether the merges that make ``a`` and ``b`` leave the border between them.

        The tokens at the border grow from single symbols, the lowest rank first and the
        left one first among equals. A merge across the border must never come earlier.
        """
        known = self.pairs.get((a, b))
        if known is not None:
            return known
        before, behind = [a], [b]
        while before[-1] in self.right:
            before.append(self.right[before[-1]])
        while behind[-1] in self.left:
            behind.append(self.left[behind[-1]])
        apart = True
        while apart:
            next_before = self.rank[before[-2]] if len(before) > 1 else NEVER
            next_behind = self.rank[behind[-2]] if len(behind) > 1 else NEVER
            across = self.merged.get((before[-1], behind[-1]), NEVER)
            if across < next_before and across <= next_behind and across < NEVER:
                apart = False
            elif next_before == next_behind == NEVER:
                break
            elif next_before <= next_behind:
                before.pop()
            else:
                behind.pop()
        if len(self.pairs) > CACHE_PAIRS:
            self.pairs.clear()
        self.pairs[a, b] = apart
        return apart

    def encode_word(self, letters: str) -> list[int]:
        """Ids of one word, given as the letters of its bytes."""
        word = letters[:-1] + self.final[letters[-1]]
        last = [-1] * (len(word) + 1)
        for end, (token, length) in self.automaton.iter(word):
            end += 1
            if last[end] < 0:
                start = end - length
                if not start or self._side_by_side(last[start], token):
                    last[end] = token
        ids, at = [], len(word)
        while at:
            ids.append(last[at])
            at -= self.length[last[at]]
        return ids[::-1]

    def _plain(self, text: str) -> bytes:
        if NEAR.fullmatch(text):
            if len(self.words) > CACHE_WORDS:
                self.words.clear()
            return b"".join(map(self.words.__getitem__, text.lower().split()))
        # Normal forms, case and character classes of all scripts as the library has them.
        matches = self.library.pre_tokenizer.pre_tokenize_str(self.library.normalizer.normalize_str(text))
        return b"".join(packed(self.encode_word(word)) for word, _ in matches)

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        if self.added_pattern is None or not self.added_pattern.search(text):
            return self._plain(text)
        return b"".join(
            self.added.get(part) or (self._plain(part) if part else b"") for part in self.added_pattern.split(text))

    def decode(self, ids: bytes) -> str:
        """Without a decoder, the tokens with a space between."""
        return " ".join(map(self.strings.__getitem__, struct.unpack(f"<{len(ids) // 4}I", ids)))


class _Words(dict):
    """Ids by what stands between white space, in lower case."""

    def __init__(self, encoder: PrefixEncoder):
        super().__init__()
        self.encoder = encoder

    def __missing__(self, chunk: str) -> bytes:
        ids: list[int] = []
        for match in MATCHES.findall(chunk):
            if not match.isascii():
                match = match.encode().decode("latin-1").translate(self.encoder.letters)
            ids += self.encoder.encode_word(match)
        out = packed(ids)
        if len(chunk) <= CACHE_CHARS:
            self[chunk] = out
        return out


@lru_cache(maxsize=2)
def prefix_encoder(path: str) -> PrefixEncoder:
    """One encoder per worker process and tokenizer."""
    return PrefixEncoder(path)


def encode_and_decode(docs: DataFrame, tokenizer: str) -> DataFrame:
    """(doc_id, ids, decoded): ids as little-endian unsigned 32-bit integers, and the text
    that they decode to.

    No shuffle. A null or empty text has no ids and decodes to an empty text; null ids
    and repeated rows are kept; an empty table gives no rows; other columns are not read.
    """
    schema = pa.schema([("doc_id", pa.int64()), ("ids", pa.binary()), ("decoded", pa.string())])

    def run(batches):
        encoder = prefix_encoder(tokenizer)
        for batch in batches:
            rows, size = [], 0
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                ids = encoder.encode(text)
                rows.append((doc_id, ids, encoder.decode(ids)))
                size += 2 * len(ids)
                if size > 8 << 20:
                    yield _arrow(rows, schema)
                    rows, size = [], 0
            yield _arrow(rows, schema)

    return identified_texts(docs).mapInArrow(run, "doc_id bigint, ids binary, decoded string")


def _arrow(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [()] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)
