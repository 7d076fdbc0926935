"""URL filters: host and path rules first, then a weighted vocabulary.

An Aho-Corasick automaton finds the vocabulary's terms in one pass over a URL. A hit counts
where neither neighbour is an ASCII letter or digit, each term once. Strict terms weigh
as much as several soft ones, and a URL is blocked from that weight on.
"""

from __future__ import annotations

from collections.abc import Iterable
from typing import NamedTuple

import ahocorasick
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

ALNUM = frozenset("0123456789abcdefghijklmnopqrstuvwxyz")

#: One of these blocks a URL.
STRICT = ("adult", "casino", "escort", "hentai", "porn", "porno", "sex", "viagra", "xxx")
#: Two different ones of these do.
SOFT = ("ads", "bet", "bets", "bonus", "cheap", "click", "farm", "free", "hot", "jackpot", "loan", "loans", "nude",
        "pill", "pills", "poker", "prize", "slots", "spam", "track", "warez", "win")


class Rule(NamedTuple):
    """``verdict`` for a host and its subdomains where the path starts with ``path``."""

    verdict: str
    host: str
    path: str = "/"


class Vocabulary(NamedTuple):
    strict: tuple[str, ...] = STRICT
    soft: tuple[str, ...] = SOFT
    #: Distinct soft terms that weigh as much as a strict one.
    soft_hits: int = 2


def split_url(url: str | None) -> tuple[str, str]:
    """(host, path): the host after the first ``://`` up to ``/``, ``?`` or ``#``, with A-Z
    in lower case; the path from there up to ``?`` or ``#``. Both empty without ``://``."""
    _, found, rest = (url or "").partition("://")
    if not found:
        return "", ""
    rest = rest.partition("#")[0].partition("?")[0]
    host, slash, path = rest.partition("/")
    return _lower(host), slash + path


_LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}


def _lower(text: str) -> str:
    return text.lower() if text.isascii() else text.translate(_LOWER)


class _Rules:
    """Rules by host and path. Looking one up costs no more for a longer URL."""

    def __init__(self, rules: Iterable[Rule]):
        self.of: dict[str, dict[str, str]] = {}
        for rule in rules:
            self.of.setdefault(rule.host, {})[rule.path] = rule.verdict
        self.longest = max(map(len, self.of), default=0)
        self.lengths = {host: sorted({*map(len, paths)}, reverse=True) for host, paths in self.of.items()}

    def find(self, host: str, path: str) -> tuple[str, str] | None:
        """(rule, verdict) of the longest rule that fits; of equally long ones that of the longer host."""
        best, at = None, len(host)
        while at > 0 and len(host) - at < self.longest:
            at = host.rfind(".", 0, at)
            domain = host[at + 1:]
            for length in self.lengths.get(domain, ()):
                verdict = self.of[domain].get(path[:length]) if length <= len(path) else None
                if verdict:
                    if best is None or len(domain) + length >= len(best[0]):
                        best = domain + path[:length], verdict
                    break
        return best


class _Terms:
    def __init__(self, words: Vocabulary):
        self.found = ahocorasick.Automaton()
        for strict, terms in ((False, words.soft), (True, words.strict)):
            for term in terms:
                self.found.add_word(_lower(term), (term, len(term), strict))
        self.empty = not len(self.found)
        self.found.make_automaton()

    def count(self, url: str) -> tuple[int, int]:
        """How many different strict and soft terms stand in a lower-case URL."""
        if self.empty:
            return 0, 0
        hits: tuple[set[str], set[str]] = (set(), set())
        for last, (term, length, strict) in self.found.iter(url):
            if (last + 1 == len(url) or url[last + 1] not in ALNUM) and (last < length or url[last - length] not in ALNUM):
                hits[not strict].add(term)
        return len(hits[0]), len(hits[1])


def judge_urls(pages: DataFrame, rules: Iterable[Rule] = (), words: Vocabulary = Vocabulary()) -> DataFrame:
    """(page_id, host, path, rule, verdict, n_strict, n_soft), one row per row of (page_id, url).

    ``rule`` is host and path of the longest rule that fits the URL, else null, and its verdict
    holds. Otherwise the vocabulary decides over the whole URL: n_strict and n_soft count the
    different terms in it, blocked if one is strict or ``soft_hits`` are soft. No shuffle; rules
    and terms are settings that every task holds, their size does not follow the data.

    A null or empty URL, or one without ``://``, has an empty host and path and no rule; its
    terms count (a null has none). Null ids and repeated rows are kept; very long URLs are read whole in
    linear time; an empty table gives no rows; other columns are not read.
    """
    rules = list(rules)

    def judge(batches):
        known, terms = _Rules(rules), _Terms(words)
        for batch in batches:
            urls = batch.column(1)
            rows = []
            for url, flat in zip(urls.to_pylist(), pc.ascii_lower(pc.fill_null(urls, "")).to_pylist()):
                host, path = split_url(url)
                rule, verdict = known.find(host, path) or (None, None)
                strict, soft = terms.count(flat)
                if rule is None:
                    verdict = "block" if strict or soft >= words.soft_hits else "allow"
                rows.append((host, path, rule, verdict, strict, soft))
            columns = list(zip(*rows)) or [()] * 6
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c, pa.string()) for c in columns[:4]), *(pa.array(c, pa.int64()) for c in columns[4:])],
                ["page_id", "host", "path", "rule", "verdict", "n_strict", "n_soft"])

    rows = pages.select(F.col("page_id").cast("bigint").alias("page_id"), F.col("url").cast("string").alias("url"))
    return rows.mapInArrow(
        judge, "page_id bigint, host string, path string, rule string, verdict string, n_strict bigint, n_soft bigint")
