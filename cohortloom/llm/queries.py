"""The registered queries op1 to op13: each applies its operator to a whole table and
derives the columns that are compared."""

from __future__ import annotations

import uuid
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..session import shared_folder
from . import (
    bpe, fingerprints, hard_negatives, id_files, language, markov, near_texts, near_vectors, packing, prefix_trie,
    secrets, sharding, url_filter,
)
from .base import id_remainder, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
WORD_BPE = public_tokenizers.path("word_bpe_49k.json")


def query(fn: Callable[[SparkSession, str], DataFrame]):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_packing(spark: SparkSession, folder: str) -> DataFrame:
    packed = packing.pack(table(spark, folder, "documents"), BYTE_BPE)
    return packed.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset", "bucket")


@query
def op2_bpe(spark: SparkSession, folder: str) -> DataFrame:
    coded = bpe.encode_and_decode(table(spark, folder, "documents"), WORD_BPE)
    return coded.select(
        "doc_id", (F.octet_length("ids") / 4).cast("bigint").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))


@query
def op3_near_vectors(spark: SparkSession, folder: str) -> DataFrame:
    return near_vectors.near_vectors(table(spark, folder, "embeddings"), 0.98)


@query
def op4_language(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    filters = language.learn(docs, language.training_label(F.col("doc_id"), F.col("lang")))
    return language.identify(docs, filters).select(
        "doc_id", (id_remainder(F.col("doc_id"), 4) == 2).alias("held_out"), "lang_pred", "score")


@query
def op5_secrets(spark: SparkSession, folder: str) -> DataFrame:
    found = secrets.scan_secrets(table(spark, folder, "documents"))

    def listed(spans):
        line = F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string")))
        return F.concat_ws(",", line)

    base = F.filter("spans", lambda s: s["kind"].isin(*secrets.BASE))
    def of(kind):
        return F.filter("spans", lambda s: s["kind"] == kind)

    counts = [F.size(of(k)).cast("bigint").alias(f"n_{k}") for k in secrets.BASE]
    return found.select(
        "doc_id", *counts, F.sha2(listed(base), 256).alias("base_sha256"), listed(F.col("spans")).alias("spans"))


@query
def op6_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    return fingerprints.fingerprint_beside_edits(table(spark, folder, "documents"))


@query
def op7_markov(spark: SparkSession, folder: str) -> DataFrame:
    return markov.score_texts(table(spark, folder, "documents"))


@query
def op8_sharding(spark: SparkSession, folder: str) -> DataFrame:
    dealt = sharding.interleave(table(spark, folder, "documents"), 40)
    return dealt.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), "source")


@query
def op9_near_texts(spark: SparkSession, folder: str) -> DataFrame:
    return near_texts.near_duplicates(table(spark, folder, "documents"), near_texts.Similarity(width=4, percent=80))


@query
def op10_id_files(spark: SparkSession, folder: str) -> DataFrame:
    path = f"{shared_folder(spark)}/{spark.sparkContext.applicationId}/ids-{uuid.uuid4().hex}"
    id_files.write_ids(table(spark, folder, "documents"), BYTE_BPE, path)
    return id_files.read_ids(spark, path).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


@query
def op11_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    return hard_negatives.hard_negatives(table(spark, folder, "embeddings"))


ORACLE["op11_hard_negatives"] = """
WITH r AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda v: CAST(floor(256 * CAST(v AS DOUBLE)) AS BIGINT)) AS q
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda v: v IS NULL OR NOT isfinite(v))) = 0),
s AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same,
    CAST(list_sum(list_transform(range(1, len(a.q) + 1), lambda i: a.q[i] * b.q[i])) AS BIGINT) AS score
  FROM r a, r b WHERE a.vec_id % 50 = 0 AND b.vec_id <> a.vec_id),
p AS (
  SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5),
n AS (
  SELECT p.anchor_id, positive_id, other_id AS negative_id, positive_score, score AS negative_score,
    row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, other_id) AS rank
  FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT s.same
    AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score
FROM n WHERE rank <= 3"""

URL_RULES = (
    url_filter.Rule("block", "net"), url_filter.Rule("allow", "example.net", "/en/"),
    url_filter.Rule("block", "example.com", "/de/"), url_filter.Rule("allow", "org", "/fr/"),
)


@query
def op12_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    return url_filter.judge_urls(table(spark, folder, "pages"), URL_RULES)


def _url_sql() -> str:
    rules = ", ".join(f"('{r.verdict}', '{r.host}', '{r.path}')" for r in URL_RULES)

    def count(terms):
        hits = [f"CAST(regexp_matches(flat, '(^|[^a-z0-9]){t}($|[^a-z0-9])') AS BIGINT)" for t in terms]
        return " + ".join(hits)

    return f"""
WITH rules(verdict, host, path) AS (VALUES {rules}),
u AS (
  SELECT page_id, translate(coalesce(url, ''), '{"".join(map(chr, range(65, 91)))}', '{"".join(map(chr, range(97, 123)))}') AS flat,
    CASE WHEN strpos(url, '://') > 0 THEN regexp_extract(substr(url, strpos(url, '://') + 3), '^[^?#]*') ELSE '' END AS rest
  FROM pages),
h AS (
  SELECT page_id, flat, substr(rest, length(regexp_extract(rest, '^[^/]*')) + 1) AS path,
    translate(regexp_extract(rest, '^[^/]*'), '{"".join(map(chr, range(65, 91)))}', '{"".join(map(chr, range(97, 123)))}') AS host
  FROM u),
c AS (SELECT *, {count(url_filter.STRICT)} AS n_strict, {count(url_filter.SOFT)} AS n_soft FROM h),
f AS (
  SELECT c.page_id, max_by(r.host || r.path, length(r.host || r.path)) AS rule,
    max_by(r.verdict, length(r.host || r.path)) AS verdict
  FROM c JOIN rules r ON (c.host = r.host OR ends_with(c.host, '.' || r.host)) AND starts_with(c.path, r.path)
  GROUP BY c.page_id)
SELECT page_id, c.host, c.path, f.rule,
  coalesce(f.verdict, CASE WHEN n_strict > 0 OR n_soft >= {url_filter.Vocabulary().soft_hits} THEN 'block' ELSE 'allow' END) AS verdict,
  n_strict, n_soft
FROM c LEFT JOIN f USING (page_id)"""


ORACLE["op12_url_filter"] = _url_sql()


@query
def op13_prefix_trie(spark: SparkSession, folder: str) -> DataFrame:
    return prefix_trie.prefix_trie(table(spark, folder, "conversations"))


#: Nodes by the text of their whole prefix; the checksum of an id goes bit by bit.
ORACLE["op13_prefix_trie"] = """
WITH t AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) AS place,
    coalesce(role, '') AS role, coalesce(text, '') AS text
  FROM conversations WHERE conv_id IS NOT NULL),
ids AS (
  SELECT conv_id, conv_id - conv_id % 100 AS base, count(*) AS n,
    xor(list_reduce(list_prepend(4294967295::BIGINT, flatten(list_transform(string_split(CAST(conv_id AS VARCHAR), ''),
      lambda ch: [CAST(ascii(ch) AS BIGINT), 0, 0, 0, 0, 0, 0, 0]))),
      lambda c, e: xor(xor(c, e) >> 1, 3988292384 * (xor(c, e) & 1))), 4294967295) % 6 AS h
  FROM t GROUP BY conv_id),
parts AS (
  SELECT c.conv_id, 0 AS side, b.place, b.role, b.text FROM ids c JOIN t b ON b.conv_id = c.base AND b.place <= c.h
  UNION ALL
  SELECT c.conv_id, 1, o.place, o.role, o.text FROM ids c JOIN t o ON o.conv_id = c.conv_id AND o.place > c.h),
turns AS (
  SELECT conv_id, row_number() OVER w AS depth, length(text) AS chars,
    string_agg(length(role) || ':' || role || length(text) || ':' || text, '') OVER w AS prefix
  FROM parts WINDOW w AS (PARTITION BY conv_id ORDER BY side, place)
  UNION ALL
  SELECT conv_id, 0, 0, '' FROM ids),
stops AS (SELECT conv_id, max_by(prefix, depth) AS prefix FROM turns GROUP BY conv_id),
ends AS (SELECT prefix, sha256(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id)) AS sha FROM stops GROUP BY prefix),
nodes AS (
  SELECT prefix, depth, min(conv_id) AS conv_id, count(*) AS n_convs, (count(*) - 1) * min(chars) AS saved
  FROM turns GROUP BY prefix, depth),
up AS (
  SELECT n.*, p.prefix AS parent, p.conv_id AS parent_conv_id FROM nodes n
  LEFT JOIN turns o ON n.depth > 0 AND o.conv_id = n.conv_id AND o.depth = n.depth - 1
  LEFT JOIN nodes p ON p.prefix = o.prefix AND p.depth = o.depth),
kids AS (SELECT parent, count(*) AS n FROM up WHERE parent IS NOT NULL GROUP BY parent),
every AS (
  SELECT u.*, coalesce(k.n, 0) AS n_children FROM up u LEFT JOIN kids k ON k.parent = u.prefix),
sub AS (
  SELECT a.prefix, count(*) FILTER (WHERE d.n_children = 0) AS n_leaves, sum(d.saved) AS saved_tokens
  FROM every d JOIN turns a ON a.conv_id = d.conv_id AND a.depth <= d.depth GROUP BY a.prefix)
SELECT e.conv_id, CAST(e.depth AS BIGINT) AS depth, e.parent_conv_id, e.n_convs, e.n_children,
  s.n_leaves, CAST(s.saved_tokens AS BIGINT) AS saved_tokens, coalesce(x.sha, sha256('')) AS ends_sha256
FROM every e JOIN sub s USING (prefix) LEFT JOIN ends x USING (prefix)"""
