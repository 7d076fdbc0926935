"""Secret scans: an Aho-Corasick automaton finds keywords in one pass over a text, and a
kind's pattern is tried only where one of its keywords begins. Kinds that carry a checksum
or an inner structure are validated by it.

Every pattern begins with its keyword, so trying it at the keyword hits from left to
right, each time beyond the match before, finds what a search of the whole text finds.
Hexadecimal runs have no keyword: of 32 digits or more, one holds three aligned blocks of
eight, so the scan looks for such blocks and widens them.
"""

from __future__ import annotations

import base64
import binascii
import json
import re
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from .base import identified_texts

BASE62 = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"


def _crc_base62(secret: str) -> bool:
    """The last six characters are the checksum of the thirty before, in base 62."""
    value, digits = binascii.crc32(secret[-36:-6].encode()), ""
    while value:
        value, digit = divmod(value, 62)
        digits = BASE62[digit] + digits
    return digits.rjust(6, "0") == secret[-6:]


def _signed_header(secret: str) -> bool:
    """The first part of a signed web token is a JSON object that names its algorithm."""
    head = secret.partition(".")[0]
    try:
        return "alg" in json.loads(base64.urlsafe_b64decode(head + "=" * (-len(head) % 4)))
    except (ValueError, TypeError):
        return False


class Kind(NamedTuple):
    name: str
    keywords: tuple[str, ...]  # in lower case
    pattern: re.Pattern
    valid: object  # of the match
    #: Where the pattern fails, it fails at all later keywords within this as well.
    stem: re.Pattern | None = None


#: In the order in which spans with the same start are listed; hex follows the second.
KINDS = (
    Kind("assign", ("password", "passwd", "secret", "token", "api_key", "apikey"),
         re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A),
         lambda m: m.end(2) - m.start(2) >= 8),
    Kind("access", ("akia",), re.compile(r"AKIA[A-Z0-9]+"), lambda m: m.end() - m.start() >= 16),
    Kind("repository", ("ghp_", "gho_", "ghu_", "ghs_", "ghr_"),
         re.compile(r"gh[pousr]_[A-Za-z0-9]{36}(?![A-Za-z0-9])"), lambda m: _crc_base62(m[0])),
    Kind("registry", ("npm_",), re.compile(r"npm_[A-Za-z0-9]{36}(?![A-Za-z0-9])"), lambda m: _crc_base62(m[0])),
    Kind("web_token", ("eyj",), re.compile(r"eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+"),
         lambda m: _signed_header(m[0]), re.compile(r"eyJ[A-Za-z0-9_-]+")),
)
ORDER = {name: i for i, name in enumerate(("assign", "access", "hex", *(k.name for k in KINDS[2:])))}
BASE = ("assign", "access", "hex")
HEX_DIGITS = 32

_IS_HEX = np.zeros(256, np.uint8)
_IS_HEX[list(b"0123456789abcdef")] = 1


@lru_cache(maxsize=1)
def _automaton() -> ahocorasick.Automaton:
    found = ahocorasick.Automaton()
    for kind, rule in enumerate(KINDS):
        for word in rule.keywords:
            found.add_word(word, (kind, len(word) - 1))
    found.make_automaton()
    return found


def _hex_runs(flat: bytes) -> Iterator[tuple[int, int]]:
    """Maximal runs of 32 or more lower-case hexadecimal digits."""
    n = len(flat) // 8
    if not n:
        return
    digits = _IS_HEX[np.frombuffer(flat, np.uint8)]
    full = np.flatnonzero(digits[:8 * n].view(np.uint64) == 0x0101010101010101)
    if not len(full):
        return
    runs = np.split(full, np.flatnonzero(np.diff(full) != 1) + 1)
    for run in runs:
        if len(run) < HEX_DIGITS // 8 - 1:
            continue
        start, end = 8 * int(run[0]), 8 * int(run[-1]) + 8
        while start and digits[start - 1]:
            start -= 1
        while end < len(digits) and digits[end]:
            end += 1
        if end - start >= HEX_DIGITS:
            yield start, end


def find_secrets(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) in code points, end exclusive, by start and then kind."""
    # One byte per code point; no pattern holds what is replaced.
    flat = text.encode("latin-1", "replace")
    spans = [("hex", *run) for run in _hex_runs(flat)]
    hits = [(end - before, kind) for end, (kind, before) in _automaton().iter(flat.lower().decode("latin-1"))]
    if hits:
        past = [0] * len(KINDS)
        for start, kind in sorted(hits):
            rule = KINDS[kind]
            if start < past[kind]:
                continue
            if m := rule.pattern.match(text, start):
                past[kind] = m.end()
                if rule.valid(m):
                    spans.append((rule.name, m.start(), m.end()))
            elif rule.stem and (m := rule.stem.match(text, start)):
                past[kind] = m.end()
    return sorted(spans, key=lambda s: (s[1], ORDER[s[0]]))


def scan_secrets(docs: DataFrame) -> DataFrame:
    """(doc_id, spans array<struct<kind, start, end>>), one row per document.

    No shuffle. Null and empty texts have no spans; null ids and repeated rows are kept;
    an empty table gives no rows; other columns are not read.
    """
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))

    def scan(batches):
        for batch in batches:
            spans = [
                [{"kind": k, "start": s, "end": e} for k, s, e in find_secrets(text)] for text in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(spans, kind)], ["doc_id", "spans"])

    return identified_texts(docs).mapInArrow(scan, "doc_id bigint, spans array<struct<kind:string,start:int,end:int>>")


def masked(text: str) -> str:
    """The text with every secret replaced by its kind; overlapping spans become one."""
    out, at = [], 0
    for kind, start, end in find_secrets(text):
        if start >= at:
            out += [text[at:start], f"[{kind}]"]
        at = max(at, end)
    return "".join([*out, text[at:]]) if out else text


def mask_secrets(docs: DataFrame) -> DataFrame:
    """All rows and columns, with secrets in ``text`` masked and ``n_chars``, if there is
    one, the length of the text as it is now. Null texts stay null."""
    names = docs.columns
    text_at = names.index("text")
    chars_at = names.index("n_chars") if "n_chars" in names else None

    def mask(batches):
        for batch in batches:
            columns = list(batch.columns)
            old = columns[text_at]
            new = pa.array([t if t is None else masked(t) for t in (x.as_py() for x in old)], old.type)
            columns[text_at] = new
            if chars_at is not None:
                kind = columns[chars_at].type
                changed = pc.not_equal(old, new)
                columns[chars_at] = pc.if_else(
                    pc.fill_null(changed, False), pc.utf8_length(new).cast(kind), columns[chars_at])
            yield pa.RecordBatch.from_arrays(columns, schema=batch.schema)

    return docs.mapInArrow(mask, docs.schema)
