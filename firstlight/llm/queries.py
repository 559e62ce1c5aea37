"""Registered queries of the operators, with their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from firstlight.llm import bk_tree, context_tree, decontam, exact_dedup, jaccard_join, language_id, nra, periodic
from firstlight.llm import sentencepieces, token_counts, toxicity, warc, wavelet
from firstlight.llm.tables import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LOWERED = f"translate(coalesce(text, ''), '{UPPER}', '{LOWER}')"


def query(name: str, sql: str | None = None):
    def add(f):
        QUERIES[name] = f
        if sql:
            ORACLE_SQL[name] = sql
        return f

    return add


@query(
    "op7_exact_dedup",
    f"""
    WITH t AS (SELECT doc_id, {LOWERED} AS norm FROM documents)
    SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
           doc_id = max(doc_id) OVER w AS kept, sha256(norm) AS text_sha256
    FROM t WINDOW w AS (PARTITION BY norm)
    """,
)
def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.dedup(table(spark, sf_dir, "documents"))


@query(
    "op9_warc",
    """
    WITH p AS (SELECT page_id, coalesce(html, '') AS html, octet_length(encode(coalesce(html, ''))) AS n FROM pages),
    g AS (SELECT *, max(page_id) OVER (PARTITION BY html) AS last FROM p)
    SELECT page_id, n::BIGINT AS payload_bytes, sha1(html) AS payload_digest,
           CASE WHEN n >= 1000 AND page_id <> last THEN 'revisit' ELSE 'response' END AS record_type,
           CASE WHEN n >= 1000 AND page_id <> last THEN last END AS refers_to
    FROM g
    """,
)
def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages"))


def _tokenizer(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@query("op8_token_counts")
def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(table(spark, sf_dir, "documents"), _tokenizer("byte_bpe_50k.json"))


@query("op10_wavelet_ids")
def op10_wavelet_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wavelet.round_trip(table(spark, sf_dir, "documents"), _tokenizer("byte_bpe_50k.json"))


@query(
    "op6_decontaminate",
    f"""
    WITH words AS (
      SELECT doc_id, regexp_extract_all({LOWERED}, '{decontam.WORD}') AS w FROM documents),
    items AS (
      SELECT item_id, regexp_extract_all({LOWERED}, '{decontam.WORD}') AS w FROM benchmark),
    sized AS (SELECT item_id, w, least({decontam.WINDOW}, len(w)) AS size FROM items WHERE len(w) > 0),
    win AS (
      SELECT DISTINCT item_id, size, array_to_string(w[i:i + size - 1], ' ') AS win
      FROM (SELECT item_id, w, size, unnest(range(1, len(w) - size + 2)) AS i FROM sized)),
    places AS (
      SELECT doc_id, i, size, array_to_string(w[i:i + size - 1], ' ') AS win
      FROM (SELECT doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS i
            FROM words, (SELECT DISTINCT size FROM sized) WHERE len(w) >= size)),
    occ AS (SELECT doc_id, i, p.size, item_id FROM places p JOIN win USING (size, win)),
    hit AS (
      SELECT doc_id, count(DISTINCT spot) AS n_hit
      FROM (SELECT doc_id, unnest(range(i, i + size)) AS spot FROM occ) GROUP BY doc_id),
    found AS (
      SELECT doc_id, count(DISTINCT item_id) AS n_items,
             string_agg(DISTINCT item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS ids
      FROM occ GROUP BY doc_id)
    SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
           sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
    FROM words LEFT JOIN hit USING (doc_id) LEFT JOIN found USING (doc_id)
    """,
)
def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op5_jaccard_join")
def op5_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.groups(table(spark, sf_dir, "documents"), width=4, threshold=85)


@query("op1_language_id")
def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.identify_held_out(table(spark, sf_dir, "documents"))


@query("op4_toxicity")
def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_held_out(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op3_sentencepiece")
def op3_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentencepieces.round_trip(table(spark, sf_dir, "documents"), _tokenizer("piece_bpe_32k.model"))


@query("op2_context_tree")
def op2_context_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return context_tree.score_held_out(table(spark, sf_dir, "documents"))


@query(
    "op11_nra_search",
    f"""
    WITH words AS (SELECT doc_id, regexp_extract_all({LOWERED}, '{nra.TERM}') AS t FROM documents),
    items AS (
      SELECT row_number() OVER (ORDER BY item_id, text) AS query, item_id,
             unnest(list_distinct(regexp_extract_all({LOWERED}, '{nra.TERM}'))) AS term FROM benchmark),
    docs AS (SELECT row_number() OVER (ORDER BY doc_id) AS doc, doc_id, t, len(t) AS n FROM words WHERE len(t) > 0),
    totals AS (SELECT count(*) AS docs, sum(n)::BIGINT AS terms FROM docs),
    post AS (
      SELECT doc, doc_id, n, term, count(*) AS tf FROM (SELECT doc, doc_id, n, unnest(t) AS term FROM docs)
      WHERE term IN (SELECT term FROM items) GROUP BY ALL),
    weight AS (
      SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w
      FROM post, totals GROUP BY term, docs),
    impact AS (
      SELECT doc, doc_id, term, w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * docs) // terms))) AS s
      FROM post JOIN weight USING (term), totals),
    scored AS (
      SELECT query, item_id, doc, doc_id, sum(s)::BIGINT AS score FROM items JOIN impact USING (term)
      GROUP BY ALL HAVING sum(s) > 0)
    SELECT item_id, row_number() OVER (PARTITION BY query ORDER BY score DESC, doc_id)::INTEGER AS rank, doc_id, score
    FROM scored QUALIFY rank <= 10
    """,
)
def op11_nra_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nra.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op12_bk_tree")
def op12_bk_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bk_tree.in_hex(table(spark, sf_dir, "documents"), width=3, radius=2)


@query("op13_periodic_runs")
def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic.digests(periodic.with_tails(table(spark, sf_dir, "documents")))
