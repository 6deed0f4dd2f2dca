"""The registered queries of this subpackage, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from bandscope.llm import bpe, decontam, embed, fim, fixity, html, near, packing, pii, rollup, toxicity, urls, whiten
from bandscope.session import scratch_path, stored


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.extract(table(spark, sf_dir, "pages").select("page_id", "url", "html"))


def embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embed.near_embeddings(table(spark, sf_dir, "embeddings"))


def warc_fixity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page as a record. The replica has letters changed in some records, some cut short and some missing."""
    turn = F.col("page_id") % 50
    other = (
        F.when(turn == 7, F.translate("html", "aeiou", "eioua"))
        .when(turn == 9, F.expr("substring(html, 1, length(html) div 2)"))
        .otherwise(F.col("html"))
    )
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html", other.alias("copy"))
    record, copy = fixity.warc_record(F.col("url"), F.col("html")), fixity.warc_record(F.col("url"), F.col("copy"))
    records = pages.select(
        F.col("page_id").cast("string").alias("record_id"),
        "page_id",
        F.octet_length(record).cast("long").alias("length"),
        F.sha2(record, 256).alias("digest"),
        F.octet_length(copy).cast("long").alias("copy_length"),
        F.sha2(copy, 256).alias("copy_digest"),
    )
    laid = stored(fixity.laid_out(records, ("page_id", "digest")), "replicas")
    replica = laid.filter("page_id % 50 <> 8").select(
        "record_id", "offset", F.col("copy_length").alias("length"), F.col("copy_digest").alias("digest")
    )
    return fixity.audit(laid.select("record_id", "offset", "length", "digest"), replica)


def benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return decontam.digest(decontam.find_matches(docs, table(spark, sf_dir, "benchmark")))


def url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page. The list holds the canonical URLs of the pages whose id ends in 3."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    listed = pages.filter("page_id % 10 = 3").select(urls.canonical(F.col("url")).alias("key"))
    return urls.judge_urls(pages, listed).select("page_id", "host", "path", "rule", "verdict")


def best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents").select("doc_id", "text"), packing.tokenizer_path())


def pii_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digest(pii.find_pii(table(spark, sf_dir, "documents").select("doc_id", "text")))


def toxicity_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = toxicity.toxicity(docs, table(spark, sf_dir, "labels"))
    return scored.select("doc_id", (toxicity.held_out_fold("doc_id") == 2).alias("held_out"), "score", "predicted")


def ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near.jaccard_join(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", "class_id", "n_links", "group_size")


def token_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of all documents, counted once; then some are deleted and some counted anew, in one batch sent twice.

    Those counted anew get the end token that packing adds to them.
    """
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "lang", "text")
    counts = stored(rollup.counted_by(docs, {"word_bpe_49k": packing.tokenizer_path()}), "token-counts")
    state = scratch_path(spark, "rollup")
    rollup.commit(state, "load", rollup.inserts(counts))
    gone = counts.filter("doc_id % 7 = 3")
    anew = counts.filter("doc_id % 7 <> 3 AND doc_id % 5 = 1")
    for _ in range(2):
        rollup.commit(state, "night", rollup.deletes(gone).unionByName(rollup.revisions(anew, F.col("n_tokens") + 1)))
    return rollup.totals(spark, state)


def embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten.whitened(table(spark, sf_dir, "embeddings"))


def bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(table(spark, sf_dir, "documents"), packing.tokenizer_path("byte_bpe_50k.json"))


def fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fim.digests(fim.pieces(table(spark, sf_dir, "documents")))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_html_extraction": html_extraction,
    "op2_embedding_near_dedup": embedding_near_dedup,
    "op3_warc_fixity": warc_fixity,
    "op4_benchmark_decontamination": benchmark_decontamination,
    "op5_url_filter": url_filter,
    "op6_best_fit_packing": best_fit_packing,
    "op7_pii": pii_spans,
    "op8_toxicity": toxicity_scores,
    "op9_ngram_jaccard": ngram_jaccard,
    "op10_token_rollup": token_rollup,
    "op11_embedding_whitening": embedding_whitening,
    "op12_bpe_round_trip": bpe_round_trip,
    "op13_fill_in_middle": fill_in_middle,
    "pipeline": corpus_pipeline.run,
}


def registry() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)


LINE = "chr(13) || chr(10)"


def record_sql(body: str) -> str:
    return f"""('WARC/1.1' || {LINE} || 'WARC-Type: response' || {LINE} || 'WARC-Target-URI: ' || coalesce(url, '') || {LINE}
        || 'Content-Length: ' || strlen(coalesce({body}, '')) || {LINE} || {LINE} || coalesce({body}, '') || {LINE} || {LINE})"""


FIXITY_SQL = f"""
WITH copies AS (
    SELECT page_id, url, html, CASE page_id % 50 WHEN 7 THEN translate(html, 'aeiou', 'eioua')
                                   WHEN 9 THEN substr(html, 1, length(html) // 2) ELSE html END AS copy
    FROM pages),
records AS (
    SELECT page_id, strlen({record_sql("html")}) AS length, sha256({record_sql("html")}) AS digest,
           strlen({record_sql("copy")}) AS copy_length, sha256({record_sql("copy")}) AS copy_digest
    FROM copies),
laid AS (
    SELECT *, coalesce(sum(length) OVER (ORDER BY page_id, digest ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS place
    FROM records)
SELECT CAST(place AS BIGINT) AS "offset", CAST(page_id AS VARCHAR) AS record_id,
       CASE WHEN page_id % 50 = 8 THEN 'missing' ELSE 'changed' END AS status, CAST(length AS BIGINT) AS length, digest,
       CASE WHEN page_id % 50 <> 8 THEN CAST(copy_length AS BIGINT) END AS their_length,
       CASE WHEN page_id % 50 <> 8 THEN copy_digest END AS their_digest
FROM laid WHERE page_id % 50 = 8 OR digest <> copy_digest"""

URL_SQL = r"""
WITH parts AS (
    SELECT page_id,
           coalesce(translate(regexp_extract(url, '(?s)://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
           coalesce(regexp_extract(url, '(?s)://([^/?#]*)([^?#]*)', 2), '') AS path,
           coalesce(substr(regexp_extract(url, '(?s)://([^/?#]*)([^?#]*)([^#]*)', 3), 2), '') AS query
    FROM pages),
cleaned AS (
    SELECT *, regexp_replace(regexp_replace(query, '(^|&)(utm_[a-z]+|ref|fbclid|gclid)=[^&]*', '', 'g'), '^&', '') AS q FROM parts),
canonical AS (
    SELECT *, CASE WHEN regexp_replace(host, '^www\.', '') <> '' THEN regexp_replace(host, '^www\.', '')
                   || regexp_replace(path, '(/index\.html?)?/*$', '') || CASE WHEN q <> '' THEN '?' || q ELSE '' END END AS canon
    FROM cleaned),
ruled AS (
    SELECT *, CASE WHEN (host = 'example.net' OR host LIKE '%.example.net') AND starts_with(path, '/en/') THEN 'example.net/en/'
                   WHEN (host = 'example.com' OR host LIKE '%.example.com') AND starts_with(path, '/de/') THEN 'example.com/de/'
                   WHEN (host = 'org' OR host LIKE '%.org') AND starts_with(path, '/fr/') THEN 'org/fr/'
                   WHEN (host = 'net' OR host LIKE '%.net') AND starts_with(path, '/') THEN 'net/' END AS rule
    FROM canonical)
SELECT page_id, host, path, rule,
       CASE WHEN rule IN ('net/', 'example.com/de/') THEN 'block' WHEN rule IS NOT NULL THEN 'allow'
            WHEN canon IN (SELECT canon FROM canonical WHERE page_id % 10 = 3 AND canon IS NOT NULL) THEN 'block' ELSE 'allow' END AS verdict
FROM ruled"""

def oracle_sql() -> dict[str, str]:
    found = {"op3_warc_fixity": FIXITY_SQL, "op5_url_filter": URL_SQL}
    if corpus_pipeline.ORACLE_SQL:
        found["pipeline"] = corpus_pipeline.ORACLE_SQL
    return found
