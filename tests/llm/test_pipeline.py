"""The pipeline against a brute-force version, and each stage on odd rows."""

import re

import numpy as np
import pytest
from .helpers import FOLDER
from tokenizers import Tokenizer

import corpus_pipeline
from cohortloom.llm import packing, queries, secrets

LIBRARY = Tokenizer.from_file(queries.BYTE_BPE)


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text))


def brute(rows):
    """doc_id to ids of the documents that are left."""
    kept = {r.doc_id: r.text for r in rows if r.text is not None and re.search(r"[^\W\d_]", r.text)}
    sets = {}
    for i, t in kept.items():
        words = words_of(t)
        sets[i] = {tuple(words[k:k + 5]) for k in range(len(words) - 4)} or {tuple(words)}
    ids, group = sorted(sets), {i: i for i in sets}
    for k, a in enumerate(ids):
        for b in ids[k + 1:]:
            if len(sets[a] & sets[b]) * 100 >= 80 * len(sets[a] | sets[b]):
                low, high = sorted((group[a], group[b]))
                group = {i: low if g == high else g for i, g in group.items()}
    out = {}
    for i in ids:
        if group[i] == i:
            found = LIBRARY.encode(secrets.masked(kept[i]), add_special_tokens=False).ids
            out[i] = np.array([*found, 1], "<u4").tobytes()
    return out


def joined(rows):
    out = {}
    for r in sorted(rows, key=lambda r: r.start):
        out[r.doc_id] = out.get(r.doc_id, b"") + bytes(r.ids)
    return out


def test_pipeline(spark, docs):
    assert joined(corpus_pipeline.run(spark, FOLDER).collect()) == brute(docs.collect())


@pytest.mark.parametrize("name", ["odd_docs", "no_docs"])
def test_stages_pass_on_all_columns(request, spark, name):
    docs = request.getfixturevalue(name)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, docs, FOLDER)
        assert after.schema.names == docs.schema.names and [f.dataType for f in after.schema] == [
            f.dataType for f in docs.schema]
        docs = spark.createDataFrame(after.collect(), docs.schema)
    left = corpus_pipeline.STAGES[-1][1](spark, docs, FOLDER).collect()
    assert {r.doc_id for r in left} == ({3, None, 11, 12, 2, 1, 21, 22} if name == "odd_docs" else set())


def test_the_stages_are_those_of_the_plan():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language", "near_duplicates", "secrets", "packing"]
    assert corpus_pipeline.ORACLE_SQL is None and packing.LIMIT == 2048
