import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from cohortloom.llm.prefix_trie import Sizes, prefix_trie

SMALL = Sizes(segment=4, keys=7, items=60, piece=5)
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def brute_force(turns):
    """The nodes as the contract words them, from (conv_id, turn, role, text)."""
    convs = defaultdict(list)
    for c, turn, role, text in turns:
        if c is not None:
            convs[c].append(((turn is not None, turn or 0), (role or "", text or "")))
    own = {c: [t for _, t in sorted(ts, key=lambda x: x[0])] for c, ts in convs.items()}
    members = defaultdict(set)
    whole = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 6
        base = c - (c % 100 if c >= 0 else -(-c % 100))
        whole[c] = tuple(own.get(base, [])[:h] + own[c][h:])
        for d in range(len(whole[c]) + 1):
            members[whole[c][:d]].add(c)
    kids = defaultdict(list)
    for p in members:
        if p:
            kids[p[:-1]].append(p)
    leaves, saved = {}, {}
    for p in sorted(members, key=len, reverse=True):
        leaves[p] = sum(leaves[k] for k in kids[p]) or 1
        saved[p] = sum(saved[k] for k in kids[p]) + (len(p) and (len(members[p]) - 1) * len(p[-1][1]))
    out = []
    for p, m in members.items():
        ends = ",".join(str(c) for c in sorted(m) if whole[c] == p)
        out.append((min(m), len(p), min(members[p[:-1]]) if p else None, len(m), len(kids[p]), leaves[p], saved[p],
                    hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out)


def got(df):
    assert df.columns == COLUMNS
    return sorted(tuple(r) for r in df.collect())


def frame(spark, turns, parts=3):
    return spark.createDataFrame(turns, "conv_id bigint, turn bigint, role string, text string").repartition(parts)


def made_up(seed, n_convs, words, longest):
    rng = random.Random(seed)
    return [(c, t, rng.choice("ua"), rng.choice(words)) for c in rng.sample(range(-150, 900), n_convs)
            for t in range(rng.randint(1, longest))]


@pytest.mark.parametrize("seed, n_convs, longest", [(1, 120, 4), (2, 60, 10)])
def test_chunks_and_segments_against_brute_force(spark, seed, n_convs, longest):
    """Chunks of a few keys and segments of four turns: several rounds and levels."""
    turns = made_up(seed, n_convs, ["x", "yy"], longest)
    want = brute_force(turns)
    assert got(prefix_trie(frame(spark, turns), SMALL)) == want
    assert got(prefix_trie(frame(spark, turns))) == want


def test_one_hot_conversation_and_one_long_one(spark):
    """A third of all conversations are equal, another is as long as all of them."""
    turns = [(c, t, "user", f"same {t}") for c in range(0, 6000, 50) for t in range(3)]
    turns += [(c, t, "user", f"{c} {t}") for c in range(1, 240) if c % 50 for t in range(2)]
    turns += [(777777, t, "user", "word") for t in range(100)]
    want = brute_force(turns)
    assert got(prefix_trie(frame(spark, turns, 7), Sizes(segment=40, keys=16, items=400, piece=20))) == want


def test_odd_rows(spark):
    """Nulls, repeated turns, empty and very long texts, an absent base, a conversation without turns."""
    turns = [(None, 1, "user", "no id"), (100, None, "user", "first"), (100, 2, None, None), (100, 3, "user", ""),
             (101, 1, "user", "long " * 200_000), (101, 2, "user", "😀é"), (102, 5, "a", "b"), (102, 5, "a", "b"),
             (205, 1, "user", "base is absent"), (110, 1, "user", "first"), (130, 1, "us", "er"), (160, 1, "use", "r")]
    turns += [(c, 1, "user", "one turn") for c in range(301, 330)]
    df = frame(spark, turns)
    clashing = df.selectExpr("*", "'k' key", "1 level", "'d' digest", "2 place", "3 part", "4 n", "5 next", "6 item")
    assert got(prefix_trie(clashing, SMALL)) == brute_force(turns)


def test_ties_are_in_a_fixed_order(spark):
    """Turns of one number: any order of the rows gives the same nodes."""
    turns = [(0, 1, "u", w) for w in "abcde"] + [(c, 1, "u", w) for c in (1, 2, 3) for w in "edcba"]
    assert got(prefix_trie(frame(spark, turns, 1))) == got(prefix_trie(frame(spark, turns[::-1], 5), SMALL))


def test_empty_table(spark):
    assert got(prefix_trie(frame(spark, []))) == []
