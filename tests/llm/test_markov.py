"""The hidden Markov model against sums over all paths, and the base against counts."""

import binascii
import math
import re
from collections import Counter
from itertools import product

import numpy as np
import pytest
from .helpers import FOLDER, texts

from cohortloom.llm import markov, queries


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def test_tokens():
    text = "Ab\x0bCD\x1ceÉ\x85f  K\n"
    assert [t.decode() for t in markov.tokens(text)] == words_of(text)


def random_model(symbols, states, seed):
    rng = np.random.default_rng(seed)
    emits, moves, start = rng.random((symbols, states)), rng.random((states, states)), rng.random(states)
    return markov.Model(start / start.sum(), moves / moves.sum(1, keepdims=True), emits / emits.sum(0))


def paths(sequence, m):
    """Probability of every path through the states together with the symbols."""
    for path in product(range(len(m.start)), repeat=len(sequence)):
        p = m.start[path[0]] * m.emits[sequence[0], path[0]]
        for t in range(1, len(path)):
            p *= m.moves[path[t - 1], path[t]] * m.emits[sequence[t], path[t]]
        yield path, p


SEQUENCES = [np.array(s, np.int32) for s in ([1, 2, 0], [0], [3, 3, 1, 2, 0], [], [2, 0], [1, 1, 1, 1, 0])]


def test_forward_sums_all_paths():
    m = random_model(4, 3, 1)
    for got, s in zip(markov.likelihoods(SEQUENCES, m), SEQUENCES):
        want = math.log10(sum(p for _, p in paths(s, m))) if len(s) else 0.0
        assert got == pytest.approx(want)


@pytest.mark.parametrize("cells", [4, 400_000])
def test_expected_counts(monkeypatch, cells):
    monkeypatch.setattr(markov, "HELD_CELLS", cells)
    m = random_model(4, 3, 2)
    start, moves, emits = np.zeros(3), np.zeros((3, 3)), np.zeros((4, 3))
    for k, s in enumerate(SEQUENCES):
        if len(s):
            total = sum(p for _, p in paths(s, m))
            for path, p in paths(s, m):
                start[path[0]] += p / total * (k != 2)
                for t, state in enumerate(path):
                    emits[s[t], state] += p / total
                    if t:
                        moves[path[t - 1], state] += p / total
    got = markov.expected_counts([(s, k != 2) for k, s in enumerate(SEQUENCES)], m)
    for a, b in zip(got, (start, moves, emits)):
        assert np.allclose(a, b)


def test_training_raises_the_likelihood(spark, docs):
    halves = markov._halves(docs)
    vocabulary, _ = markov.learn_vocabulary(markov.count_words(halves))
    encoded = markov.encode(halves, vocabulary).cache()
    sequences = [np.frombuffer(r.symbols, "<u2").astype(np.int32) for r in encoded.where("not held_out").collect()]
    scores = [sum(markov.likelihoods(sequences, markov.train(encoded, vocabulary.n_symbols, 4, rounds=k))) for k in (0, 1, 3)]
    assert scores[0] < scores[1] < scores[2]


def base_of(docs):
    held = {i: binascii.crc32(str(i if i is not None else "").encode()) % 7 == 2 for i, _ in docs}
    count = Counter()
    for i, t in docs:
        if not held[i]:
            count.update([*words_of(t), ""])
    n, v = sum(count.values()), len(count)
    out = {}
    for i, t in docs:
        own = [*words_of(t), ""]
        out[i] = (held[i], len(own), sum(count[w] > 0 for w in own), n,
                  sum(math.log10((count[w] + 1) / (n + v + 1)) for w in own))
    return out


def check(rows, docs):
    want = base_of(docs)
    assert len(rows) == len(want)
    for r in rows:
        held, tokens, known, n, base = want[r.doc_id]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held, tokens, known, n)
        assert r.base_score == pytest.approx(base, rel=1e-9, abs=1e-9)
        assert math.isfinite(r.score) and r.score <= 0


@pytest.mark.parametrize("share", [5e-6, 2e-3, 0.5])
def test_rare_words_are_joined(spark, docs, monkeypatch, share):
    """Whatever is known to the tasks, the scores are the same but for rounding."""
    monkeypatch.setattr(markov, "KNOWN_SHARE", share)
    monkeypatch.setattr(markov, "SYMBOL_SHARE", 0.6)
    monkeypatch.setattr(markov, "HELD_WORDS", 1000)
    rows = markov.score_texts(docs, states=2, rounds=1).collect()
    check(rows, texts(docs))
    total = sum(r.score for r in rows)
    assert total == pytest.approx(TOTALS.setdefault("score", total), rel=1e-6)


TOTALS: dict[str, float] = {}


def test_odd_rows(odd_docs, no_docs):
    check(markov.score_texts(odd_docs, states=2, rounds=1).collect(), texts(odd_docs))
    assert markov.score_texts(no_docs).collect() == []
    twice = markov.score_texts(odd_docs.union(odd_docs), states=2, rounds=1)
    assert twice.count() == 2 * odd_docs.count()


def test_nothing_to_learn_from(odd_docs):
    held = odd_docs.where("crc32(cast(string(doc_id) as binary)) % 7 = 2")
    check(markov.score_texts(held, states=2, rounds=1).collect(), texts(held))


def test_query(spark, docs):
    rows = queries.QUERIES["op7_markov"](spark, FOLDER).collect()
    check(rows, texts(docs))
    held = [r for r in rows if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)
