"""Interleaving against the definition."""

import binascii
from collections import Counter, defaultdict

import pytest
from .helpers import FOLDER

from cohortloom.llm import queries, sharding


def check(rows, shards, n):
    assert len(rows) == n
    sizes = Counter(r.shard for r in rows)
    assert max(sizes.values()) - min([sizes[s] for s in range(shards)]) <= 1
    slots, mix, total = defaultdict(list), Counter(), Counter()
    for r in rows:
        slots[r.shard].append(r.slot)
        mix[r.shard, r.source] += 1
        total[r.source] += 1
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    for (shard, source), k in mix.items():
        # A cut between two places may fall on either side of one row per source.
        assert abs(k - total[source] / shards) <= len(total) / 2 + 1, (shard, source)


@pytest.mark.parametrize("cells", [1, 7, 1024])
def test_every_shard_matches_the_mixture(docs, cells):
    check(sharding.interleave(docs, 5, cells=cells).collect(), 5, docs.count())


def test_fractional_ranks_decide(docs):
    """The shards are runs of the order by fractional rank."""
    rows = sharding.interleave(docs, 4, cells=16).collect()
    by_source = defaultdict(list)
    for r in sorted(rows, key=lambda r: (r.shard, r.slot)):
        by_source[r.source].append(r)
    place = {r.doc_id: (k + 0.5) / len(own) for own in by_source.values() for k, r in enumerate(own)}
    order = [place[r.doc_id] for r in sorted(rows, key=lambda r: (r.shard, r.slot))]
    assert order == sorted(order)


def test_odd_rows(odd_docs, no_docs):
    check(sharding.interleave(odd_docs, 3).collect(), 3, odd_docs.count())
    check(sharding.interleave(odd_docs.union(odd_docs), 3).collect(), 3, 2 * odd_docs.count())
    assert sharding.interleave(no_docs, 3).collect() == []
    assert {r.shard for r in sharding.interleave(odd_docs, 40).collect()} <= set(range(40))


def test_seeds_differ(docs):
    a, b = (sorted(map(tuple, sharding.interleave(docs, 4, seed=s).collect())) for s in (1, 2))
    assert a != b and a == sorted(map(tuple, sharding.interleave(docs, 4, seed=1).collect()))


def test_query(spark, docs):
    rows = queries.QUERIES["op8_sharding"](spark, FOLDER).collect()
    check(rows, 40, docs.count())
    want = {r.doc_id: (r.text or "").encode() for r in docs.collect()}
    assert {r.doc_id: (r.size, r.text_crc32) for r in rows} == {
        i: (len(t) + 16, binascii.crc32(t)) for i, t in want.items()}
    assert {(r.law, r.grown_shard) for r in rows} == {("rows", None)}
