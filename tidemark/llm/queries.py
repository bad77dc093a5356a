"""The registered queries of the corpus operators, with production parameters, over whole tables."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tidemark.llm.common import table
from tidemark.llm import license_scan, toxicity
from tidemark.llm.decontamination import contamination
from tidemark.llm.exact_dedup import exact_groups
from tidemark.llm.filter_audit import filter_audit
from tidemark.llm.hard_negatives import hard_negatives
from tidemark.llm.html_text import extract_text
from tidemark.llm.order_minhash import near_duplicates
from tidemark.llm.piece_codec import encode_decode
from tidemark.llm.simhash import near_classes
from tidemark.llm.token_count import token_counts
from tidemark.llm.token_store import read_store, write_store
from tidemark.llm.warc import page_records, write_archives

PIECE_MODEL = "piece_bpe_32k.model"
WORD_MODEL = "word_bpe_49k.json"


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(table(spark, sf_dir, "documents", "doc_id", "text"), public_tokenizers.path(PIECE_MODEL))


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_groups(table(spark, sf_dir, "documents", "doc_id", "text"))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents", "doc_id", "text")
    return toxicity.score(documents, toxicity.train(documents, table(spark, sf_dir, "labels", "doc_id", "toxic")))


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return page_records(write_archives(table(spark, sf_dir, "pages", "page_id", "url", "html")))


def op5_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents", "doc_id", "text"))


def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents", "doc_id", "text")
    return license_scan.scan(documents, license_scan.train(documents))


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination(table(spark, sf_dir, "documents", "doc_id", "text"), table(spark, sf_dir, "benchmark", "item_id", "text"))


def op8_piece_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_decode(table(spark, sf_dir, "documents", "doc_id", "text"), public_tokenizers.path(PIECE_MODEL))


def op9_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents", "doc_id", "text")
    return read_store(*write_store(documents, public_tokenizers.path(WORD_MODEL), end_id=1))


def op10_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_text(table(spark, sf_dir, "pages", "page_id", "url", "html"))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hard_negatives(table(spark, sf_dir, "embeddings", "vec_id", "label", "embedding"))


def op12_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_classes(table(spark, sf_dir, "documents", "doc_id", "text"))


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit(table(spark, sf_dir, "documents", "doc_id", "text", "source"), table(spark, sf_dir, "labels", "doc_id", "quality", "toxic"))


_OPERATORS = (
    op1_token_counts, op2_exact_dedup, op3_toxicity, op4_warc, op5_order_minhash, op6_license_scan, op7_decontamination,
    op8_piece_codec, op9_token_store, op10_html_text, op11_hard_negatives, op12_simhash, op13_filter_audit,
)
QUERIES = {f.__name__: f for f in _OPERATORS}

ORACLE_SQL: dict[str, str] = {
    "op2_exact_dedup": r"""
        WITH d AS (SELECT doc_id, length(coalesce(text, '')) AS cp, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS norm FROM documents),
        r AS (SELECT *, first_value(doc_id) OVER (PARTITION BY norm ORDER BY cp DESC, doc_id) AS keep_id, count(*) OVER (PARTITION BY norm) AS group_size FROM d)
        SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(norm) AS text_sha256 FROM r""",
    "op4_warc": """
        WITH p AS (SELECT page_id, coalesce(html, '') AS html, octet_length(encode(coalesce(html, ''))) AS n FROM pages),
        m AS (SELECT html, max(page_id) AS top FROM p WHERE n >= 1000 GROUP BY html)
        SELECT p.page_id, p.n AS payload_bytes, sha1(p.html) AS payload_digest,
               CASE WHEN m.top IS NULL OR m.top = p.page_id THEN 'response' ELSE 'revisit' END AS record_type,
               CASE WHEN m.top <> p.page_id THEN m.top END AS refers_to
        FROM p LEFT JOIN m ON p.n >= 1000 AND p.html = m.html""",
    "op11_hard_negatives": """
        WITH v AS (SELECT row_number() OVER () AS n, vec_id AS id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda e: floor(256 * e::DOUBLE)) AS x
                   FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND len(list_filter(embedding, lambda e: e IS NULL OR NOT isfinite(e))) = 0),
        s AS (SELECT a.n, a.id AS anchor_id, v.id, a.label = v.label AS alike, CAST(list_dot_product(a.x, v.x) AS BIGINT) AS score FROM v AS a JOIN v ON a.id % 100 = 0 AND a.n <> v.n),
        p AS (SELECT *, row_number() OVER (PARTITION BY n ORDER BY score DESC, id) AS k FROM s WHERE alike QUALIFY k <= 5),
        r AS (SELECT p.anchor_id, p.id AS positive_id, row_number() OVER (PARTITION BY p.n, p.k ORDER BY s.score DESC, s.id) AS rank, s.id AS negative_id, p.score AS positive_score, s.score AS negative_score
              FROM p JOIN s ON s.n = p.n AND NOT s.alike AND 30 * p.score <= 100 * s.score AND 100 * s.score <= 90 * p.score)
        SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score FROM r WHERE rank <= 10""",
    "op13_filter_audit": r"""
        WITH t AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text FROM documents),
        w AS (SELECT *, list_filter(regexp_split_to_array(text, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words, min(doc_id) OVER (PARTITION BY text) AS first FROM t),
        l AS (SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels GROUP BY doc_id),
        f AS (SELECT part, coalesce(l.good, false) AS good, coalesce(l.toxic, false) AS toxic,
                     list_filter(['A', 'B', 'C', 'D', 'E'], lambda x, i: [len(words) < 200, 100 * len(list_distinct(words)) < 50 * len(words),
                         100 * length(regexp_replace(text, '[^A-Z]+', '', 'g')) > 2 * length(text), regexp_matches(text, '[#$%&*|]'), coalesce(w.doc_id > first, false)][i]) AS fails
              FROM w LEFT JOIN l ON w.doc_id = l.doc_id),
        g AS (SELECT part, good, toxic, fails, count(*) AS n FROM f GROUP BY ALL),
        c AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
        o AS (SELECT a.x || b.x || c.x || d.x || e.x AS filter_order FROM c AS a, c AS b, c AS c, c AS d, c AS e
              WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5),
        s AS (SELECT part, filter_order, step, fails, good, toxic, n, substr(filter_order, step, 1) AS own,
                     list_min(list_transform(fails, lambda x: instr(filter_order, x))) AS falls FROM g, o, (SELECT unnest(range(1, 6)) AS step)),
        r AS (SELECT part, filter_order, CAST(step AS INTEGER) AS step, own, CAST(coalesce(sum(n) FILTER (falls IS NULL OR falls > step), 0) AS BIGINT) AS kept,
                     CAST(coalesce(sum(n) FILTER (falls = step), 0) AS BIGINT) AS removed,
                     CAST(coalesce(sum(n) FILTER (list_contains(fails, own) AND falls < step), 0) AS BIGINT) AS redundant,
                     CAST(coalesce(sum(n) FILTER (fails = [own]), 0) AS BIGINT) AS unique_fails,
                     CAST(coalesce(sum(n) FILTER (falls = step AND good), 0) AS BIGINT) AS good_lost,
                     CAST(coalesce(sum(n) FILTER (falls = step AND toxic), 0) AS BIGINT) AS toxic_lost FROM s GROUP BY part, filter_order, step, own)
        SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, CAST(sum(removed) OVER (PARTITION BY part, own) AS BIGINT) AS shapley FROM r""",
}
