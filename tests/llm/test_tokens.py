"""Packing and id files against the tokenizers library."""

import binascii
from collections import Counter, defaultdict

import numpy as np
import pytest
from .helpers import FOLDER, texts
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from cohortloom.llm import id_files, packing, queries
from cohortloom.llm.tokens import PieceEncoder

LIBRARY = Tokenizer.from_file(queries.BYTE_BPE)
ENCODER = PieceEncoder(queries.BYTE_BPE)


def ids_of(text, end):
    return np.array([*LIBRARY.encode(text or "", add_special_tokens=False).ids, end], "<u4").tobytes()


@settings(max_examples=400, deadline=None)
@given(st.text(st.sampled_from(" \n\t\x1c\x85　ab'sZé😀1.<|endoftext|>"), max_size=30) | st.text(max_size=40)
       | st.lists(st.sampled_from(["<|endoftext|>", " ", "  ", "\n", "it's", "don't ", "Ärger", "7"])).map("".join))
def test_pieces_give_the_ids_of_whole_texts(text):
    assert ENCODER.encode(text) == ids_of(text, 0)[:-4]


def test_a_full_cache_starts_anew(monkeypatch):
    monkeypatch.setattr("cohortloom.llm.tokens.CACHE_PIECES", 3)
    own = PieceEncoder(queries.BYTE_BPE)
    for text in ["a b c d e f", "c d e f g", "f e d " + "y" * 100]:
        assert own.encode(text) == ids_of(text, 0)[:-4]


@pytest.mark.parametrize("n,want", [(0, []), (1, [1]), (2047, [1024, 512, 256, 128, 64, 32, 16, 8, 4, 2, 1]),
                                    (2048, [2048]), (5000, [2048, 2048, 512, 256, 128, 8])])
def test_binary_lengths(n, want):
    assert list(packing.binary_lengths(n, 2048)) == want


@pytest.mark.parametrize("name", ["docs", "odd_docs"])
def test_packed_pieces_make_up_the_documents(request, name):
    docs = request.getfixturevalue(name)
    rows = packing.pack(docs, queries.BYTE_BPE).collect()
    assert len({r.sequence_id for r in rows}) == len(rows)
    pieces = defaultdict(list)
    for r in rows:
        assert r.length & (r.length - 1) == 0 and r.length <= 2048 and r.offset == 0
        assert len(r.ids) == 4 * r.length and 1 << r.bucket == r.length
        pieces[r.doc_id].append((r.start, r.ids, r.doc_tokens))
    want = {i: ids_of(t, 1) for i, t in texts(docs)}
    assert {i: b"".join(p[1] for p in sorted(ps)) for i, ps in pieces.items()} == want
    assert all(p[2] * 4 == len(want[i]) for i, ps in pieces.items() for p in ps)


def test_repeated_rows_are_packed_each(odd_docs):
    one = packing.pack(odd_docs, queries.BYTE_BPE).count()
    assert packing.pack(odd_docs.union(odd_docs), queries.BYTE_BPE).count() == 2 * one


def test_packing_nothing(no_docs):
    assert packing.pack(no_docs, queries.BYTE_BPE).collect() == []
    with pytest.raises(ValueError):
        packing.pack(no_docs, queries.BYTE_BPE, limit=100)


def test_buckets_hold_equal_lengths(spark, odd_docs, tmp_path):
    packing.write_buckets(packing.pack(odd_docs, queries.BYTE_BPE), str(tmp_path / "b"))
    read = spark.read.parquet(str(tmp_path / "b"))
    assert {(r.bucket, r.length) for r in read.collect()} == {
        (r.length.bit_length() - 1, r.length) for r in read.collect()}


def test_packing_query(spark, docs):
    want = Counter()
    for i, t in texts(docs):
        ids, at = ids_of(t, 1), 0
        for n in packing.binary_lengths(len(ids) // 4, 2048):
            want[i, at, n, binascii.crc32(ids[4 * at:4 * (at + n)]), len(ids) // 4] += 1
            at += n
    got = queries.QUERIES["op1_packing"](spark, FOLDER).collect()
    assert Counter((r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens) for r in got) == want


@pytest.mark.parametrize("kind", ["byte", "bit"])
@pytest.mark.parametrize("n", [1, 7, 8, 1000])
def test_planes_round_trip(kind, n):
    ids = np.random.default_rng(n).integers(0, 2**32, n, dtype=np.uint32)
    ids[: n // 2] %= 50_000
    assert (id_files.from_planes(id_files.to_planes(ids, kind), n, kind) == ids).all()
    zeros = id_files.to_planes(np.zeros(n, np.uint32), kind)
    assert not any(zeros) and not id_files.from_planes(zeros, n, kind).any()


def expected_starts(docs, end):
    at, out = 0, []
    for i, t in sorted(texts(docs), key=lambda x: (x[0] is not None, x[0])):
        ids = ids_of(t, end)
        out.append((i, at, len(ids) // 4, ids))
        at += len(ids) // 4
    return out


@pytest.mark.parametrize("kind", ["byte", "bit"])
def test_files_give_back_what_was_written(spark, odd_docs, tmp_path, kind):
    folder = str(tmp_path / "ids")
    manifest = id_files.write_ids(odd_docs, queries.BYTE_BPE, folder, kind=kind, block_ids=64).collect()
    assert sum(r.n_docs for r in manifest) == odd_docs.count()
    got = sorted(id_files.read_ids(spark, folder).collect(), key=lambda r: r.start)
    assert [(r.doc_id, r.start, r.n_tokens, bytes(r.ids)) for r in got] == expected_starts(odd_docs, 0)


def test_a_block_is_read_alone(spark, odd_docs, tmp_path):
    folder = str(tmp_path / "ids")
    file = id_files.write_ids(odd_docs.coalesce(1), queries.BYTE_BPE, folder, block_ids=64).first().file
    fs, at = id_files._at(file)
    reader = id_files.PlaneReader(fs.open_input_file(at))
    whole = b"".join(d[2] for d in reader.documents())
    k = len(reader.chunks) // 2
    assert reader.block(k).tobytes() == whole[256 * k:256 * k + 4 * reader.chunks[k]["n_ids"]]


def test_files_of_nothing(spark, no_docs, tmp_path):
    folder = str(tmp_path / "ids")
    assert id_files.write_ids(no_docs, queries.BYTE_BPE, folder).collect() == []
    assert id_files.read_ids(spark, folder).collect() == []


def test_ties_in_the_order_are_all_written(spark, odd_docs, tmp_path):
    folder = str(tmp_path / "ids")
    id_files.write_ids(odd_docs.union(odd_docs), queries.BYTE_BPE, folder)
    got = sorted(id_files.read_ids(spark, folder).collect(), key=lambda r: r.start)
    assert Counter((r.doc_id, bytes(r.ids)) for r in got) == Counter(
        {(i, ids): 2 for i, _, _, ids in expected_starts(odd_docs, 0)})
    assert all(a.start + a.n_tokens == b.start for a, b in zip(got, got[1:]))


def test_files_query(spark, docs):
    got = sorted(tuple(r) for r in queries.QUERIES["op10_id_files"](spark, FOLDER).collect())
    assert got == [(i, s, n, binascii.crc32(ids)) for i, s, n, ids in expected_starts(docs, 0)]


@settings(max_examples=600, deadline=None)
@given(st.lists(st.text(st.characters(max_codepoint=0x24F), min_size=1, max_size=8), max_size=6).map(" ".join))
def test_texts_of_near_characters(text):
    assert ENCODER.encode(text) == ids_of(text, 0)[:-4]


def test_every_near_character_alone_and_among_others():
    for code in range(0x250):
        for text in (f"a {chr(code)}", f"a x{chr(code)}y", f"a 1{chr(code)}2", f"a !{chr(code)}?"):
            assert ENCODER.encode(text) == ids_of(text, 0)[:-4], (code, text)


def test_the_bound_of_the_cache_is_kept():
    own = PieceEncoder(queries.BYTE_BPE, cache_pieces=10)
    for k in range(50):
        text = f"a word{k} and another{k} of {k} words"
        assert own.encode(text) == ENCODER.encode(text)
        assert len(own.cache) <= 10 + len(text.split())
