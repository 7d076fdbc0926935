import re

import pytest

from cohortloom.llm.url_filter import Rule, Vocabulary, judge_urls, split_url

RULES = (Rule("block", "net"), Rule("allow", "example.net", "/en/"), Rule("block", "example.com", "/de/"), Rule("allow", "org", "/fr/"))


def brute_force(url, rules, words):
    m = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", url or "")
    fold = lambda x: re.sub("[A-Z]", lambda c: c[0].lower(), x)
    host, path = (fold(m[1]), m[2]) if m else ("", "")
    fits = [r for r in rules if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    best = max(fits, key=lambda r: (len(r.host + r.path), len(r.host)), default=None)
    strict, soft = (sum(bool(re.search(f"(?<![a-z0-9]){re.escape(t)}(?![a-z0-9])", fold(url or ""))) for t in terms)
                    for terms in (words.strict, words.soft))
    verdict = best.verdict if best else "block" if strict or soft >= words.soft_hits else "allow"
    return host, path, best and best.host + best.path, verdict, strict, soft


URLS = [
    None, "", "no scheme", "http://", "http://a.net", "http://a.net/", "HTTP://WWW.Example.NET/en/x", "http://example.net/en",
    "http://notexample.com/de/x", "http://m.example.com/de/x?y", "http://m.example.com/DE/x", "http://org/fr/", "http://x.org/fr?/fr/",
    "http://a.net:80/", "http://.net/", "http://net/", "x://y://z.net/p", "http://h.com?://q.net/", "http://h.com#/de/",
    "http://adult.com/", "http://adulthood.com/", "http://cheap-pills.com/", "http://cheap.cheap.com/cheap", "http://h.com/a?free=1#BETS",
    "http://h.com/free_bets", "http://h.com/İfreeİbet", "http://h.com/ſex/sex", "http://h.com/casino\n", "http://h.com/xxxx/xxx",
    "http://" + "a." * 50_000 + "net/" + "free/" * 50_000, "http://h.com/win/win", "http://h.com/win/spam",
]


def test_against_brute_force(spark):
    rows = [(i % 7 or None, u, "k") for i, u in enumerate(URLS)] * 2
    df = spark.createDataFrame(rows, "page_id bigint, url string, host string").repartition(3)
    got = sorted(map(repr, map(tuple, judge_urls(df, RULES).collect())))
    assert got == sorted(repr((i, *brute_force(u, RULES, Vocabulary()))) for i, u, _ in rows)


def test_longest_rule_wins(spark):
    rules = (*RULES, Rule("block", "b.org", "/fr/x"), Rule("allow", "a.b.org", "/fr/x/y"), Rule("block", "co", "/ab"), Rule("allow", "x.co", "/"))
    words = Vocabulary(("bad",), ("so", "so-so", "meh"), 3)
    urls = ["http://q.a.b.org/fr/x/y/z", "http://q.b.org/fr/x/y", "http://q.b.org/fr/y", "http://x.co/ab", "http://so-so.com/meh", "http://so.com/meh"]
    df = spark.createDataFrame(list(enumerate(urls)), "page_id bigint, url string")
    got = {r["page_id"]: tuple(r)[1:] for r in judge_urls(df, rules, words).collect()}
    assert got == {i: brute_force(u, rules, words) for i, u in enumerate(urls)}
    assert got[4][3] == "block" and got[5][3] == "allow"


def test_without_rules_terms_or_rows(spark):
    df = spark.createDataFrame([(1, "http://casino.net/")], "page_id bigint, url string")
    assert judge_urls(df, (), Vocabulary((), ())).first()["verdict"] == "allow"
    assert judge_urls(df.where("page_id = 2"), RULES).collect() == []


@pytest.mark.parametrize("url, want", [("A://B/C", ("b", "/C")), ("://É.X?", ("É.x", "")), ("a:/b", ("", ""))])
def test_split(url, want):
    assert split_url(url) == want
