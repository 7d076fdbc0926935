"""Dynamic programming over prefixes against the tokenizers library."""

import hashlib

import numpy as np
from .helpers import FOLDER, by_id, texts
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from cohortloom.llm import bpe, queries

LIBRARY = Tokenizer.from_file(queries.WORD_BPE)
ENCODER = bpe.PrefixEncoder(queries.WORD_BPE)


def ids_of(text):
    return np.array(LIBRARY.encode(text or "", add_special_tokens=False).ids, "<u4").tobytes()


def decoded(ids):
    return LIBRARY.decode(np.frombuffer(ids, "<u4").tolist(), skip_special_tokens=False)


@settings(max_examples=500, deadline=None)
@given(st.text(max_size=40) | st.text("aàbehtins'lvd 1é\n", max_size=60)
       | st.lists(st.sampled_from(["<|endoftext|>", "<|startoftext|>", " ", "é", "İ", "ΑΣ", "aaaaaaaa", "it's", "\x1c",
                                   "\x85", "&&&", "12", "Å"])).map("".join)
       | st.text(st.characters(max_codepoint=0x24F), max_size=20))
def test_ids_and_text_are_those_of_the_library(text):
    ids = ENCODER.encode(text)
    assert ids == ids_of(text)
    assert ENCODER.decode(ids) == decoded(ids)


@settings(max_examples=300, deadline=None)
@given(st.text("abcdeinorst", min_size=1, max_size=300) | st.text("ab", min_size=1, max_size=200))
def test_long_words(word):
    assert ENCODER.encode(word) == ids_of(word)


def test_full_caches_start_anew(monkeypatch, docs):
    monkeypatch.setattr(bpe, "CACHE_WORDS", 5)
    monkeypatch.setattr(bpe, "CACHE_PAIRS", 5)
    own = bpe.PrefixEncoder(queries.WORD_BPE)
    for _, t in texts(docs)[:10]:
        assert own.encode(t) == ids_of(t)


def test_odd_rows(odd_docs, no_docs):
    got = bpe.encode_and_decode(odd_docs, queries.WORD_BPE).collect()
    assert {r.doc_id: (bytes(r.ids), r.decoded) for r in got} == {
        i: (ids_of(t), decoded(ids_of(t))) for i, t in texts(odd_docs)}
    assert bpe.encode_and_decode(odd_docs.union(odd_docs), queries.WORD_BPE).count() == 2 * len(got)
    assert bpe.encode_and_decode(no_docs, queries.WORD_BPE).collect() == []


def test_query(spark, docs):
    got = by_id(queries.QUERIES["op2_bpe"](spark, FOLDER))
    want = {i: ids_of(t) for i, t in texts(docs)}
    assert {i: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for i, r in got.items()} == {
        i: (len(x) // 4, hashlib.sha256(x).hexdigest(), hashlib.sha256(decoded(x).encode()).hexdigest())
        for i, x in want.items()}


def test_every_near_character():
    for code in range(0x250):
        for text in (f"a {chr(code)}", f"a x{chr(code)}y", f"1{chr(code)}2", f"!{chr(code)}?"):
            assert ENCODER.encode(text) == ids_of(text), (code, text)
