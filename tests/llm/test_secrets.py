"""Secret scans against plain searches of the whole text."""

import base64
import binascii
import hashlib
import re
import time

import pytest
from .helpers import FOLDER, by_id, texts
from hypothesis import given, settings, strategies as st

from cohortloom.llm import queries, secrets
from cohortloom.llm.secrets import KINDS, find_secrets

TOKEN_HEAD = base64.urlsafe_b64encode(b'{"alg":"none"}').decode().rstrip("=")

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)


def plain(text):
    spans = [("assign", m.start(), m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    spans += [("access", m.start(), m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    spans += [("hex", m.start(), m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 32]
    return sorted(spans, key=lambda s: (s[1], secrets.ORDER[s[0]]))


def base_of(text):
    return [s for s in secrets.find_secrets(text) if s[0] in secrets.BASE]


PARTS = ["password", "PassWD", "secret", "ſecret", "toKen", "api_key", "apikey", "=", ":", " ", '"', "'", "é", "😀",
         "AKIA", "akia", "ABCDEFGH12345678", "abcdef0123456789", "deadbeef" * 4, "x", "\n", "İ", "-", "=="]


@settings(max_examples=600, deadline=None)
@given(st.lists(st.sampled_from(PARTS), max_size=14).map("".join))
def test_base_spans_are_those_of_plain_searches(text):
    assert base_of(text) == plain(text)


def made(prefix, body):
    value, digits = binascii.crc32(body.encode()), ""
    for _ in range(6):
        value, d = divmod(value, 62)
        digits = secrets.BASE62[d] + digits
    return prefix + body + digits


def test_checksums_decide():
    good = made("ghp_", "A1b2C3d4E5" * 3)
    assert secrets.find_secrets(f"x {good}.") == [("repository", 2, 2 + 40)]
    assert secrets.find_secrets(f"x {good[:-1]}{'0' if good[-1] != '0' else '1'}.") == []
    assert secrets.find_secrets(made("npm_", "Z" * 30)) == [("registry", 0, 40)]
    assert secrets.find_secrets("eyJhbGciOiJIUzI1NiJ9.e30.c2ln") == [("web_token", 0, 29)]
    assert secrets.find_secrets("eyJub3RoaW5nIjoxfQ.e30.c2ln") == []


def test_masking(odd_docs):
    rows = {r.doc_id: r for r in secrets.mask_secrets(odd_docs).collect()}
    assert rows[2].text == "[assign]' and [access] [hex]X" and rows[2].n_chars == len(rows[2].text)
    assert rows[7].text is None and rows[7].n_chars is None and rows[5].text == ""
    assert secrets.mask_secrets(odd_docs).columns == odd_docs.columns
    assert secrets.masked("token=deadbeefdeadbeefdeadbeefdeadbeef end") == "[assign] end"
    unchanged = {i: t for i, t in texts(odd_docs) if i != 2}
    assert {i: r.text for i, r in rows.items() if i != 2} == unchanged


def test_nothing(no_docs):
    assert secrets.scan_secrets(no_docs).collect() == [] and secrets.mask_secrets(no_docs).collect() == []


def test_odd_rows(odd_docs):
    got = {r.doc_id: [tuple(s) for s in r.spans] for r in secrets.scan_secrets(odd_docs).collect()}
    assert got == {i: secrets.find_secrets(t or "") for i, t in texts(odd_docs)}


def test_query(spark):
    folder = FOLDER.replace("0.001", "0.01")
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    got = by_id(queries.QUERIES["op5_secrets"](spark, folder))
    assert any(r.n_assign and r.n_hex for r in got.values())
    assert len(got) == docs.count()
    for i, t in texts(docs):
        want = plain(t or "")
        r = got[i]
        line = ",".join(f"{k}:{s}:{e}" for k, s, e in want)
        assert r.base_sha256 == hashlib.sha256(line.encode()).hexdigest()
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(sum(s[0] == k for s in want) for k in secrets.BASE)
        assert set(line.split(",")) - {""} <= set(r.spans.split(","))


def test_keywords_without_end_take_linear_time():
    """A segment of a million keywords is looked at once; what follows is found all the same."""
    token = f"{TOKEN_HEAD}.eyJ4Ijox.c2ln"
    hostile = "eyJ" * 1_000_000
    start = time.perf_counter()
    spans = find_secrets(f"{hostile} {token} eyJa.{hostile} {token}")
    assert time.perf_counter() - start < 20
    at = len(hostile) + 1
    second = at + len(token) + len(" eyJa.") + len(hostile) + 1
    assert [s for s in spans if s[0] == "web_token"] == [
        ("web_token", at, at + len(token)), ("web_token", second, second + len(token))]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(["eyJ", ".", "a", "-", " ", "EYJ", TOKEN_HEAD]), max_size=14).map("".join))
def test_web_tokens_as_by_plain_search(text):
    rule = next(k for k in KINDS if k.name == "web_token")
    want = [(rule.name, *m.span()) for m in rule.pattern.finditer(text) if rule.valid(m)]
    assert [s for s in find_secrets(text) if s[0] == rule.name] == want
