"""The operators of this package over the standard tables, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import importance, langid, licenses, lines, mixing, oracle, pieces, pii, quality, simhash, topk, urls, vafile, warc

MODEL = "piece_bpe_32k.model"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def bounded_batches(spark: SparkSession) -> None:
    """Arrow batches by size, so that very long texts cannot fill a worker's memory."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(4 << 20))


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    bounded_batches(spark)
    docs = _table(spark, sf_dir, "documents")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 == 1, F.lit(False))
    net = langid.fit(docs.filter(~held_out))
    return langid.identify(docs, net).select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op2_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    bounded_batches(spark)
    return pieces.digests(_table(spark, sf_dir, "documents"), public_tokenizers.path(MODEL))


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    entries = quality.ledger(_table(spark, sf_dir, "documents"))
    base_failed = ~quality.passes(quality.BASE)
    return entries.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        base_failed.alias("base_failed"),
        (~base_failed & quality.passes(quality.CURRENT)).alias("kept"),
        "fail_bits",
    )


def op4_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(_table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken", "source", "copies")


def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge(_table(spark, sf_dir, "pages")).select("page_id", "host", "path", "rule", "verdict")


def op6_warc_fixity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Audit of a replica in which every record with page_id divisible by 97 is damaged."""
    leaves = warc.layout(warc.replicas(_table(spark, sf_dir, "pages"), F.col("page_id") % 97 == 0), ["page_id", "digest_a"])
    return warc.audit(leaves).select("page_id", "idx", "archive", "offset", "length", "digest_a", "digest_b")


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    bounded_batches(spark)
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    spans = F.transform("removed", lambda r: F.concat_ws("@", F.concat_ws("-", r["start"].cast("string"), r["end"].cast("string")), r["first_doc_id"].cast("string")))
    return lines.dedup_lines(docs).select("doc_id", "text", "n_removed", F.array_join(spans, ",").alias("removed"))


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    bounded_batches(spark)
    return simhash.near_duplicates(_table(spark, sf_dir, "documents"))


def op9_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    bounded_batches(spark)
    return topk.search(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(_table(spark, sf_dir, "documents"))


def op11_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    bounded_batches(spark)
    spans = F.col("spans")
    found = pii.find(_table(spark, sf_dir, "documents"))
    base = F.filter(spans, lambda s: s["kind"].isin(*pii.BASE))
    return found.select(
        "doc_id", *(pii.count_of(kind, spans).alias(f"n_{kind}") for kind in pii.BASE),
        F.sha2(pii.joined(base), 256).alias("base_sha256"), pii.joined(spans).alias("spans"),
        F.array_join(F.transform(spans, lambda s: s["score"].cast("string")), ",").alias("scores"),
    )


def op12_centroid_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    bounded_batches(spark)
    return vafile.with_inertia(*vafile.cluster(_table(spark, sf_dir, "embeddings")))


def op13_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    bounded_batches(spark)
    rows = importance.resample(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return importance.with_ranks(rows).select("doc_id", "n_features", "weight", "score", "rank")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_language_id, op2_sentencepiece, op3_quality_rules, op4_source_mixing, op5_url_filter,
        op6_warc_fixity, op7_line_dedup, op8_simhash, op9_topk_search, op10_license_scan,
        op11_pii, op12_centroid_clusters, op13_importance_resampling,
    )
}

_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

#: DuckDB statements with the same columns; operators that SQL cannot express have none.
ORACLE_SQL: dict[str, str] = oracle.ORACLE_SQL | {
    "op3_quality_rules": rf"""
        WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t, {_WORDS} AS w FROM documents),
        word AS (SELECT r, unnest(w) AS x, generate_subscripts(w, 1) AS i FROM d),
        gram AS (
            SELECT r, i, x || ' ' || lead(x, 1) OVER s || ' ' || lead(x, 2) OVER s || ' ' || lead(x, 3) OVER s || ' ' || lead(x, 4) OVER s AS g
            FROM word WINDOW s AS (PARTITION BY r ORDER BY i)),
        twice AS (SELECT r, i FROM gram WHERE g IS NOT NULL QUALIFY count(*) OVER (PARTITION BY r, g) > 1),
        covered AS (SELECT r, count(DISTINCT i + k) AS n FROM twice, range(5) AS o(k) GROUP BY r),
        line AS (SELECT r, unnest(string_split(t, chr(10))) AS x FROM d),
        lined AS (
            SELECT r, count(*) AS n_lines, count(*) - count(DISTINCT x) AS n_dup
            FROM line WHERE regexp_matches(x, '[^\x20\x09-\x0D]') GROUP BY r),
        m AS (
            SELECT doc_id, len(w) AS n_words,
                   length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g')) AS word_chars,
                   length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
                   length(regexp_replace(t, '[^!]', '', 'g')) AS n_exclaims,
                   coalesce(n_dup, 0) AS n_dup_lines, coalesce(n_lines, 0) AS n_lines, coalesce(n, 0) AS n_repeat_words
            FROM d LEFT JOIN covered USING (r) LEFT JOIN lined USING (r)),
        f AS (SELECT *, {" + ".join(f"CASE WHEN {sql} THEN {1 << i} ELSE 0 END" for i, (_, sql) in enumerate(quality.RULES))} AS fail_bits FROM m)
        SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols,
               n_dup_lines::BIGINT AS n_dup_lines, n_repeat_words::BIGINT AS n_repeat_words,
               n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
               fail_bits = 0 AS kept, fail_bits::BIGINT AS fail_bits
        FROM f
    """,
    "op6_warc_fixity": rf"""
        WITH w AS (
            SELECT *, concat('WARC/1.1', chr(13), chr(10), 'WARC-Type: response', chr(13), chr(10), 'WARC-Record-ID: <urn:page:', page_id,
                '>', chr(13), chr(10), 'WARC-Target-URI: ', url, chr(13), chr(10), 'Content-Length: ', strlen(coalesce(html, '')),
                chr(13), chr(10), chr(13), chr(10)) AS head, chr(13) || chr(10) || chr(13) || chr(10) AS tail
            FROM pages),
        r AS (
            SELECT page_id, concat(head, html, tail) AS a,
                   concat(head, CASE WHEN page_id % 97 = 0 AND length(html) > 0 THEN left(html, length(html) - 1) || chr(0) ELSE html END, tail) AS b
            FROM w),
        d AS (SELECT page_id, strlen(a) AS length, sha256(a) AS digest_a, sha256(b) AS digest_b FROM r),
        o AS (
            SELECT *, row_number() OVER g - 1 AS idx, (sum(length) OVER g - length)::BIGINT AS "offset"
            FROM d WINDOW g AS (ORDER BY page_id NULLS LAST, digest_a ROWS UNBOUNDED PRECEDING))
        SELECT page_id, idx, "offset" // {warc.ARCHIVE_BYTES} AS archive, "offset", length, digest_a, digest_b
        FROM o WHERE digest_a <> digest_b
    """,
    "op9_topk_search": f"""
        WITH v AS (
            SELECT vec_id, list_transform(min(embedding), lambda x: floor({topk.SCALE} * x::DOUBLE)::BIGINT) AS v
            FROM embeddings
            WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
            GROUP BY vec_id),
        s AS (
            SELECT q.vec_id AS query_id, c.vec_id AS vec_id, list_inner_product(q.v::DOUBLE[], c.v::DOUBLE[])::BIGINT AS score
            FROM v AS q JOIN v AS c ON q.vec_id <> c.vec_id WHERE q.vec_id % 20 = 0)
        SELECT query_id, (row_number() OVER g)::INTEGER AS rank, vec_id, score
        FROM s WINDOW g AS (PARTITION BY query_id ORDER BY score DESC, vec_id)
        QUALIFY row_number() OVER g <= {topk.K}
    """,
}
