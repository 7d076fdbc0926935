"""Fingerprints against a parse with a set of byte strings, and pairs against the order."""

import hashlib

import numpy as np
import pytest
from .helpers import FOLDER, texts
from hypothesis import given, settings, strategies as st

from cohortloom.llm import fingerprints as fp, queries


def phrases_of(data):
    seen, start = set(), 0
    for end in range(1, len(data) + 1):
        if data[start:end] not in seen:
            seen.add(data[start:end])
            start = end
    return seen


@settings(max_examples=200, deadline=None)
@given(st.binary(max_size=300) | st.text("ab", max_size=300).map(str.encode), st.integers(0, 300))
def test_parse(data, cut):
    want = set()
    for phrase in phrases_of(data):
        state = fp.SEED
        for byte in phrase:
            state = (state * fp.MULTIPLIER ^ byte) & fp.BITS48
        want.add(state)
    got = set()
    fp.parse(data[cut:], got, fp.parse(data[:cut], got))
    assert got == want


def test_likeness_estimates_the_share_of_common_phrases():
    rng = np.random.default_rng(1)
    a = {int(x) for x in rng.integers(0, 1 << 48, 4000)}
    b = {int(x) for x in rng.integers(0, 1 << 48, 2000)} | set(list(a)[:2000])
    exact = len(a & b) / len(a | b)
    assert abs(fp.likeness(fp.smallest(a), fp.smallest(b)) - exact) < 0.12
    assert fp.likeness(fp.smallest(a), fp.smallest(a)) == 1
    assert fp.likeness(fp.smallest(set()), fp.smallest(a)) == 0
    assert fp.likeness(fp.smallest(set()), fp.smallest(set())) == 1
    assert (fp.read(fp.written(fp.smallest(a))) == fp.smallest(a)).all()


def plain(text):
    seen = set()
    fp.parse(text.encode(), seen)
    return fp.smallest(seen)


def check(rows, docs):
    order = sorted(((i, t or "") for i, t in texts(docs)), key=lambda x: (x[0] is not None, x[0]))
    assert len(rows) == len(order)
    got = {r.doc_id: r for r in rows}
    for k, (i, t) in enumerate(order):
        follower = order[(k + 1) % len(order)][1]
        n = len(t) // 4
        edited = t[:len(t) - n] + follower[:n]
        r = got[i]
        assert r.n_chars == len(t)
        assert r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert r.fingerprint == fp.written(plain(t)) and r.edited_fingerprint == fp.written(plain(edited))
        assert r.near_edited == fp.likeness(plain(t), plain(edited))
        assert r.near_next == fp.likeness(plain(t), plain(follower))


@pytest.mark.parametrize("runs", [1, 2, 5, 40, None])
def test_every_document_meets_its_next(odd_docs, runs):
    check(fp.fingerprint_beside_edits(odd_docs, runs).collect(), odd_docs)


def test_one_and_no_document(odd_docs, no_docs):
    one = odd_docs.where("doc_id = 3")
    check(fp.fingerprint_beside_edits(one).collect(), one)
    assert fp.fingerprint_beside_edits(no_docs).collect() == []
    assert fp.fingerprint(no_docs).collect() == []


def test_repeated_rows(odd_docs):
    rows = fp.fingerprint_beside_edits(odd_docs.union(odd_docs)).collect()
    assert len(rows) == 2 * odd_docs.count()
    assert all(r.fingerprint == fp.written(plain(dict(texts(odd_docs))[r.doc_id] or "")) for r in rows)


def test_plain_fingerprints(odd_docs):
    got = {r.doc_id: r.fingerprint for r in fp.fingerprint(odd_docs).collect()}
    assert got == {i: fp.written(plain(t or "")) for i, t in texts(odd_docs)}
    assert got[3] == got[13] and got[7] == got[5] == ""


def test_query(spark, docs):
    rows = queries.QUERIES["op6_fingerprints"](spark, FOLDER).collect()
    check(rows, docs)
    long = [r for r in rows if r.n_chars > 400]
    assert np.mean([r.near_edited for r in long]) > np.mean([r.near_next for r in long]) + 0.3
