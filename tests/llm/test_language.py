"""Language identification: held-out accuracy, and the filters against sets of n-grams."""

import numpy as np
from .helpers import FOLDER, by_id
from pyspark.sql import functions as F

from cohortloom.llm import language, queries


def test_held_out_accuracy(spark):
    folder = FOLDER.replace("0.001", "0.01")
    labels = {r.doc_id: r.lang for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    got = by_id(queries.QUERIES["op4_language"](spark, folder))
    assert set(got) == set(labels)
    held = [r for r in got.values() if r.held_out and r.lang_pred != "und"]
    assert len(held) > 150
    assert np.mean([r.lang_pred == labels[r.doc_id] for r in held]) >= 0.97
    assert all(0 <= r.score <= 1 for r in got.values())


def test_grams():
    grams, ends = language.grams_of([b" ab ", b" x ", b" abc "])
    as_bytes = [int(g).to_bytes(4, "little") for g in grams]
    assert as_bytes == [b" ab ", b" x  ", b" abc", b"abc "] and ends.tolist() == [1, 2, 4]
    assert language.letters_of("It's  ÉTÉ-2\n") == " it s été ".encode()


def test_filters_hold_every_frequent_gram(docs):
    filters = language.learn(docs, F.col("lang"), sample_docs=10**9)
    rows = [r for r in docs.collect() if r.lang is not None and r.text is not None]
    counts = {}
    for r in rows:
        grams, _ = language.grams_of([language.letters_of(r.text)])
        own = counts.setdefault(r.lang, {})
        for g in grams.tolist():
            own[g] = own.get(g, 0) + 1
    share = {k: {g: n / sum(c.values()) for g, n in c.items()} for k, c in counts.items()}
    (slots,) = filters.slots
    for lang, own in share.items():
        bit, inside, kept = filters.languages.index(lang), [], 0.0
        for g, s in own.items():
            most = max(x.get(g, 0) for x in share.values() if x.get(g, 0) >= language.LEAST_SHARE) if s >= language.LEAST_SHARE else 1
            if s >= language.LEAST_SHARE and s >= language.LEAST_RATIO * most:
                inside.append(g)
                kept += s
        mask = np.full(len(inside), np.iinfo(slots.dtype).max, slots.dtype)
        for places in language._slots(np.array(inside, np.uint32)):
            mask &= slots[places]
        assert ((mask >> bit) & 1).all()
        assert abs(filters.own[bit] - kept) < 1e-9


def test_the_label_of_held_out_documents_is_not_seen(docs):
    shown = language.training_label(F.col("doc_id"), F.col("lang"))
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2
    changed = docs.withColumn("lang", F.when(held, F.lit("xx")).otherwise(F.col("lang")))
    a, b = language.learn(docs, shown), language.learn(changed, shown)
    assert a.languages == b.languages and (a.slots == b.slots).all()


def test_odd_rows(odd_docs, no_docs):
    filters = language.learn(odd_docs, F.col("lang"))
    got = by_id(language.identify(odd_docs, filters))
    assert len(got) == odd_docs.count()
    assert got[7].lang_pred == got[5].lang_pred == got[20].lang_pred == "und" and got[7].score == 0
    assert got[22].lang_pred in ("en", "fr")
    kept = language.keep_identified(odd_docs, filters)
    assert kept.columns == odd_docs.columns
    assert {r.doc_id for r in kept.collect()} == set(got) - {7, 5, 20}
    assert language.identify(no_docs, filters).collect() == []


def test_without_labels_nothing_is_known(odd_docs, no_docs):
    for docs in (no_docs, odd_docs.withColumn("lang", F.lit(None).cast("string"))):
        filters = language.learn(docs, F.col("lang"))
        assert filters.languages == []
        assert {r.lang_pred for r in language.identify(odd_docs, filters).collect()} == {"und"}


def test_without_labels_texts_with_letters_stay(odd_docs):
    unlabelled = odd_docs.withColumn("lang", F.lit(None).cast("string"))
    kept = language.keep_identified(unlabelled, language.learn(unlabelled, F.col("lang")))
    assert {r.doc_id for r in kept.collect()} == {r.doc_id for r in odd_docs.collect()} - {7, 5, 20}


def test_slices_cover_all_texts(monkeypatch):
    """Every text is in one slice, in order; a text that is longer than a slice is taken alone."""
    from cohortloom.llm import language

    monkeypatch.setattr(language, "SLICE", 10)
    for texts in ([], [None], ["x" * 30], ["abc", None, "x" * 11, "", "abcdef", "abcde", "x" * 99, None]):
        parts = [texts[part] for part in language.in_slices(texts)]
        assert [t for part in parts for t in part] == texts
        assert all(len(part) == 1 or sum(len(t or "") for t in part) <= 10 for part in parts if any(part))


def test_more_languages_than_a_mask_holds(spark):
    """100 labels, each with words of its own: decisions equal those by exact sets of n-grams."""
    import random

    rng = random.Random(11)
    words = [["".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(6)) for _ in range(30)] for _ in range(100)]
    rows = [(k * 10 + n, " ".join(rng.choices(words[k], k=40)), f"l{k:03}") for k in range(100) for n in range(4)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    filters = language.learn(docs, F.col("lang"), sample_docs=10**9)
    assert len(filters.languages) == 100 and filters.slots.shape == (2, 1 << language.SLOT_BITS)
    sets = {}
    for _, text, lang in rows:
        sets.setdefault(lang, set()).update(language.grams_of([language.letters_of(text)])[0].tolist())
    new = [" ".join(rng.choices(words[k], k=25) + rng.choices(words[(k * 7 + 1) % 100], k=8)) for k in range(100)]
    got, scores, borne = language.decide(new, filters)
    for text, lang, score in zip(new, got, scores):
        grams = language.grams_of([language.letters_of(text)])[0].tolist()
        exact = {k: sum(g in s for g in grams) / filters.own[filters.languages.index(k)] for k, s in sets.items()}
        assert lang == max(exact, key=exact.get)
        assert abs(score - exact[lang] / sum(exact.values())) < 0.02
    assert got == [f"l{k:03}" for k in range(100)] and all(borne)


def test_more_languages_than_tables_are_made_for(spark, monkeypatch):
    import pytest

    monkeypatch.setattr(language, "MOST_LANGUAGES", 3)
    docs = spark.createDataFrame([(k, "some text", str(k)) for k in range(4)], "doc_id bigint, text string, lang string")
    with pytest.raises(ValueError):
        language.learn(docs, F.col("lang"))


def test_a_text_of_no_learned_language_goes(spark, docs):
    filters = language.learn(docs, F.col("lang"))
    greek = "η γλώσσα αυτή δεν υπάρχει πουθενά στα κείμενα που έχουμε διαβάσει ως τώρα "
    rows = [(1, greek * 3), (2, "γεια"), (3, "12 34"), (4, None), (5, docs.where("text is not null").first().text), (6, "zqxj " * 60)]
    kept = language.keep_identified(spark.createDataFrame(rows, "doc_id bigint, text string"), filters)
    assert {r.doc_id for r in kept.collect()} == {2, 5}


def test_the_stage_keeps_every_clean_document(spark):
    docs = spark.read.parquet(f"{FOLDER.replace('0.001', '0.01')}/documents.parquet")
    kept = language.keep_identified(docs, language.learn(docs, F.col("lang")))
    assert kept.count() == docs.where("text rlike '[^\\\\W\\\\d_]'").count()
