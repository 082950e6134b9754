"""Registered queries of the corpus operators, at production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsekit.llm.common import table

BYTE_TOKENIZER = "byte_bpe_50k.json"
WORD_TOKENIZER = "word_bpe_49k.json"


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_kn_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pulsekit.llm.kn_quality import quality

    return quality(table(spark, sf_dir, "documents"), trusted_ids(spark, sf_dir))


def trusted_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that people judged to be of good quality."""
    return table(spark, sf_dir, "labels").where("quality = 1").select("doc_id")


def op2_byte_cnn_lang(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pulsekit.llm.byte_cnn_lang import identify

    return identify(table(spark, sf_dir, "documents"))


def op3_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pulsekit.llm.token_store import store_and_read

    return store_and_read(table(spark, sf_dir, "documents"), tokenizer_path(BYTE_TOKENIZER), end_id=2)


def op4_lz_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pulsekit.llm.lz_fingerprint import edited_likeness

    return edited_likeness(table(spark, sf_dir, "documents"))


def op5_gbt_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pulsekit.llm.gbt_toxicity import toxicity

    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pulsekit.llm.token_counts import count_tokens, over_limit

    return over_limit(count_tokens(table(spark, sf_dir, "documents"), tokenizer_path(WORD_TOKENIZER)), 2048)


def op7_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pulsekit.llm.jaccard_join import join

    return join(table(spark, sf_dir, "documents"), words=4, num=85, den=100).select(
        "doc_id", "n_shingles", "component_id")


def jaccard_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pulsekit.llm.jaccard_join import links

    return links(table(spark, sf_dir, "documents"), words=4, num=85, den=100).select(
        "doc_id", "n_shingles", "links")


def op8_ann_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pulsekit.llm.ann_projection import search

    return search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def op9_bin_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pulsekit.llm.bin_packing import pack_documents

    return pack_documents(table(spark, sf_dir, "documents"), tokenizer_path(BYTE_TOKENIZER), end_id=0, capacity=2048)


def op10_bpe_backtrack(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pulsekit.llm.bpe_backtrack import digests

    return digests(table(spark, sf_dir, "documents"), tokenizer_path(WORD_TOKENIZER))


def op11_cover_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pulsekit.llm.cover_topk import search

    return search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def op12_word_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pulsekit.llm.word_runs import digests, planted, runs

    return digests(runs(table(spark, sf_dir, "documents"), edit=planted))


def op13_turn_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pulsekit.llm.turn_repair import damaged, digests, repair

    conversations = table(spark, sf_dir, "conversations")
    return digests(repair(damaged(conversations)), conversations)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_kn_quality, op2_byte_cnn_lang, op3_token_store, op4_lz_fingerprint, op5_gbt_toxicity,
        op6_token_counts, op7_jaccard_join, jaccard_links, op8_ann_projection, op9_bin_packing,
        op10_bpe_backtrack, op11_cover_topk, op12_word_runs, op13_turn_repair)
}

#: All pairs of documents that share a shingle, and what they reach.
JACCARD_SQL = r"""
WITH RECURSIVE
split AS (
    SELECT doc_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x20\x09-\x0D]+') AS w
    FROM documents),
sets AS (
    SELECT doc_id, CASE WHEN len(w) = 0 THEN []
                        WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
                        ELSE list_distinct(list_transform(range(1, len(w) - 2),
                                                          lambda i: array_to_string(w[i:i + 3], ' '))) END AS s
    FROM split),
member AS (SELECT doc_id, unnest(s) AS t FROM sets),
shared AS (
    SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n
    FROM member a JOIN member b ON a.t = b.t AND a.doc_id <> b.doc_id GROUP BY ALL),
link AS (
    SELECT a, b FROM shared JOIN sets x ON x.doc_id = a JOIN sets y ON y.doc_id = b
    WHERE 100 * n >= 85 * (len(x.s) + len(y.s) - n)),
reach(doc_id, other) AS (
    SELECT doc_id, doc_id FROM sets
    UNION
    SELECT r.doc_id, l.b FROM reach r JOIN link l ON l.a = r.other)
SELECT s.doc_id, CAST(len(any_value(s.s)) AS BIGINT) AS n_shingles, min(r.other) AS component_id
FROM sets s JOIN reach r ON r.doc_id = s.doc_id GROUP BY s.doc_id"""

#: With how many other sets each document's set links.
JACCARD_LINKS_SQL = r"""
WITH
split AS (
    SELECT doc_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x20\x09-\x0D]+') AS w
    FROM documents),
sets AS (
    SELECT doc_id, list_sort(CASE WHEN len(w) = 0 THEN []
                        WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
                        ELSE list_distinct(list_transform(range(1, len(w) - 2),
                                                          lambda i: array_to_string(w[i:i + 3], ' '))) END) AS s
    FROM split),
class AS (SELECT s, row_number() OVER () AS c FROM (SELECT DISTINCT s FROM sets)),
member AS (SELECT c, unnest(s) AS t FROM class),
shared AS (
    SELECT a.c AS a, b.c AS b, count(*) AS n
    FROM member a JOIN member b ON a.t = b.t AND a.c <> b.c GROUP BY ALL),
found AS (
    SELECT a, count(*) AS links FROM shared JOIN class x ON x.c = a JOIN class y ON y.c = b
    WHERE 100 * n >= 85 * (len(x.s) + len(y.s) - n) GROUP BY a)
SELECT sets.doc_id, CAST(len(sets.s) AS BIGINT) AS n_shingles, CAST(coalesce(f.links, 0) AS BIGINT) AS links
FROM sets JOIN class ON class.s = sets.s LEFT JOIN found f ON f.a = class.c"""

#: Every query against every other vector.
COVER_TOPK_SQL = """
WITH whole AS (
    SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
    FROM embeddings
    WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
pairs AS (
    SELECT q.vec_id AS query_id, c.vec_id, CAST(coalesce(list_sum(list_transform(
               range(1, len(q.e) + 1), lambda i: q.e[i] * c.e[i])), 0) AS BIGINT) AS score
    FROM whole q JOIN whole c ON q.vec_id <> c.vec_id AND len(q.e) = len(c.e) AND q.vec_id % 50 = 0)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
       vec_id, score
FROM pairs
QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) <= 5"""

#: DuckDB statements of the queries that SQL can express.
ORACLE: dict[str, str] = {"op7_jaccard_join": JACCARD_SQL, "jaccard_links": JACCARD_LINKS_SQL,
                          "op11_cover_topk": COVER_TOPK_SQL}
