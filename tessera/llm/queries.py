"""The registered queries of this subpackage over the test tables, and their
DuckDB SQL where SQL can express them.

Each callable takes ``(spark, sf_dir)``, applies one operator with its
production parameters to the whole table, and derives the digest columns.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (bottom_k, decontaminate, jaccard_join, language_id, lexical_search, lz_fingerprint, sentencepiece_codec,
               sharding, suffix_dedup, token_alignment, token_files, url_filter, warc_audit)
from ..plans import write_through

# fixed values: host, path, verdict of the URL rules
URL_RULES = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"),
             ("net", "/es/", "block"), ("net", "/fr/", "block")]
SHARDS = 8
END_ID = 2
TOP_DOCUMENTS = 50


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_url_filters(spark, sf_dir):
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return url_filter.judge_urls(table(spark, sf_dir, "pages"), rules)


def op2_sharding(spark, sf_dir):
    placed = sharding.shard_documents(table(spark, sf_dir, "documents"), SHARDS)
    return placed.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                         F.lit(None).cast("int").alias("grown_shard"))


def op3_suffix_dedup(spark, sf_dir):
    return suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"))


def op4_decontamination(spark, sf_dir):
    found = decontaminate.search_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("bigint").alias("n_items"),
                        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"), "contaminated")


def op5_sentencepiece(spark, sf_dir):
    coded = sentencepiece_codec.encode_decode(table(spark, sf_dir, "documents"),
                                              public_tokenizers.path("piece_bpe_32k.model"))
    return coded.select("doc_id", F.size("ids").cast("bigint").alias("n_tokens"),
                        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
                        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


def op6_language_id(spark, sf_dir):
    return language_id.predict_languages(table(spark, sf_dir, "documents"))


def op7_jaccard_join(spark, sf_dir):
    return jaccard_join.join_documents(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_shingles", "component_id", "n_links")


def op8_token_files(spark, sf_dir):
    manifest = token_files.write_token_files(table(spark, sf_dir, "documents"),
                                             public_tokenizers.path("byte_bpe_50k.json"), END_ID)
    read = token_files.read_token_files(spark, manifest)
    return read.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op9_lz_fingerprints(spark, sf_dir):
    return lz_fingerprint.compare_with_edits(table(spark, sf_dir, "documents"))


def op10_warc_audit(spark, sf_dir):
    # a second replica derived from the table: one page in 40 has its first byte changed, as many are lost; it
    # keeps the places of the original, where a changed byte moves nothing and a lost record leaves a gap
    fate = F.conv(F.substr(F.md5(F.concat(F.lit("fate"), F.coalesce(F.col("page_id").cast("string"), F.lit("")))
                                 .cast("binary")), F.lit(1), F.lit(8)), 16, 10).cast("bigint") % 40
    html = F.when(fate == 0, F.concat(F.lit("X"), F.substr("html", F.lit(2)))).otherwise(F.col("html"))
    there = F.sha2(warc_audit.record_text(F.col("page_id"), F.col("url"), html).cast("binary"), 256)
    laid = write_through(warc_audit.lay_out(table(spark, sf_dir, "pages"), extra={"copy": there, "lost": fate == 1}),
                         "layout")
    replica = laid.where(~F.col("lost")).drop("digest").withColumnRenamed("copy", "digest")
    located = warc_audit.audit(laid, replica)
    status = F.coalesce("status", F.lit("same"))
    return (laid.join(located, warc_audit.PLACE, "left")
            .select("page_id", "file", "record_offset", "n_bytes", F.col("digest").alias("sha256"),
                    F.when(status == "same", F.col("digest")).otherwise(F.col("there")).alias("replica_sha256"),
                    status.alias("status")))


def op11_lexical_search(spark, sf_dir):
    index = write_through(lexical_search.build_index(table(spark, sf_dir, "documents")), "index")
    return lexical_search.search(index, table(spark, sf_dir, "benchmark"), TOP_DOCUMENTS)


def op12_token_alignment(spark, sf_dir):
    return token_alignment.align_tokenizers(
        table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN,
        public_tokenizers.path("piece_bpe_32k.model"))


def op13_bottom_k(spark, sf_dir):
    return bottom_k.near_duplicates(table(spark, sf_dir, "documents"), shingle=2)


QUERIES = {name: fn for name, fn in sorted(globals().items()) if name.startswith("op") and callable(fn)}

_RULES_SQL = ", ".join(f"('{h}', '{p}', '{v}')" for h, p, v in URL_RULES)

ORACLE_SQL = {
    "op1_url_filters": f"""
        WITH rest AS (
            SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS r
            FROM pages),
        cut AS (SELECT page_id, regexp_extract(r, '^[^/?#]*') AS h, r FROM rest),
        parts AS (
            SELECT page_id, translate(h, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
                   regexp_extract(substr(r, length(h) + 1), '^[^?#]*') AS path FROM cut),
        rules(rhost, rpath, verdict) AS (VALUES {_RULES_SQL}),
        best AS (
            SELECT host, path, max_by(rhost || rpath, length(rhost || rpath)) AS rule,
                   max_by(verdict, length(rhost || rpath)) AS verdict
            FROM (SELECT DISTINCT host, path FROM parts) p
            JOIN rules ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath)
            GROUP BY host, path)
        SELECT page_id, p.host, p.path, rule, coalesce(verdict, 'allow') AS verdict
        FROM parts p LEFT JOIN best b ON p.host = b.host AND p.path = b.path""",
    "op3_suffix_dedup": """
        WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h, strlen(coalesce(text, '')) AS n FROM documents),
        strings AS (
            SELECT doc_id, p, substr(h, 2 * p + 1, 100) AS s
            FROM (SELECT doc_id, h, unnest(range(0, n - 49)) AS p FROM d)),
        least AS (SELECT s, min(doc_id) AS first FROM strings GROUP BY s HAVING count(DISTINCT doc_id) > 1),
        gone AS (
            SELECT doc_id, p, p > lag(p) OVER (PARTITION BY doc_id ORDER BY p) + 50 AS apart
            FROM strings JOIN least USING (s) WHERE first < doc_id),
        runs AS (
            SELECT doc_id, p, count(*) FILTER (apart) OVER (PARTITION BY doc_id ORDER BY p) AS run FROM gone),
        spans AS (SELECT doc_id, min(p) AS a, max(p) + 50 AS z FROM runs GROUP BY doc_id, run),
        gaps AS (
            SELECT d.doc_id, a, z, n, h, coalesce(lag(z) OVER (PARTITION BY d.doc_id ORDER BY a), 0) AS before
            FROM spans JOIN d ON d.doc_id = spans.doc_id),
        cut AS (
            SELECT doc_id, sum(z - a) AS n_removed, count(*) AS n_spans,
                   string_agg(substr(h, 2 * before + 1, 2 * (a - before)), '' ORDER BY a)
                   || substr(any_value(h), 2 * max(z) + 1) AS kept
            FROM gaps GROUP BY doc_id)
        SELECT d.doc_id, n::BIGINT AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed,
               coalesce(n_spans, 0)::BIGINT AS n_spans, sha256(unhex(coalesce(kept, h))) AS kept_sha256
        FROM d LEFT JOIN cut c ON d.doc_id = c.doc_id""",
    "op4_decontamination": r"""
        WITH dw AS (
            SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                   'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
        iw AS (
            SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                   'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
        strings AS (
            SELECT DISTINCT item_id, s, len(s) AS n FROM (
                SELECT item_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 10 THEN [w]
                       ELSE list_transform(range(1, len(w) - 8), lambda i: w[i:i + 9]) END) AS s FROM iw)),
        lengths AS (SELECT DISTINCT n FROM strings),
        runs AS (
            SELECT doc_id, n, p, w[p:p + n - 1] AS s
            FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS p FROM dw, lengths)),
        hits AS (SELECT doc_id, item_id, p, r.n FROM runs r JOIN strings t ON r.n = t.n AND r.s = t.s),
        marked AS (
            SELECT doc_id, count(DISTINCT q) AS n_hit
            FROM (SELECT doc_id, unnest(range(p, p + n)) AS q FROM hits) GROUP BY doc_id),
        listed AS (
            SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
            FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM hits WHERE item_id IS NOT NULL)
            GROUP BY doc_id)
        SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
               sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
        FROM dw d LEFT JOIN marked m ON d.doc_id = m.doc_id LEFT JOIN listed l ON d.doc_id = l.doc_id""",
    "op7_jaccard_join": r"""
        WITH RECURSIVE words AS (
            SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                   'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
        sets AS (
            SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [w]
                   ELSE list_transform(range(1, len(w) - 1), lambda i: w[i:i + 2]) END) AS s FROM words),
        members AS (SELECT doc_id, len(s) AS n, hash(unnest(s)) AS h FROM sets),
        pairs AS (
            SELECT a.doc_id AS x, b.doc_id AS y FROM members a JOIN members b ON a.h = b.h AND a.doc_id != b.doc_id
            GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 90 * (a.n + b.n - count(*))),
        reach(x, y) AS (
            SELECT doc_id, doc_id FROM sets UNION SELECT r.x, p.y FROM reach r JOIN pairs p ON r.y = p.x),
        least AS (SELECT x, min(y) AS component_id FROM reach GROUP BY x),
        counts AS (SELECT x, count(*) AS n_links FROM pairs GROUP BY x)
        SELECT s.doc_id, len(s.s)::BIGINT AS n_shingles, component_id, coalesce(n_links, 0) AS n_links
        FROM sets s JOIN least l ON s.doc_id = l.x LEFT JOIN counts c ON s.doc_id = c.x""",
    "op10_warc_audit": r"""
        WITH fates AS (
            SELECT *, ('0x' || substr(md5('fate' || coalesce(page_id::VARCHAR, '')), 1, 8))::BIGINT % 40 AS fate
            FROM pages),
        bodies AS (
            SELECT *, coalesce(html, '') AS body,
                   coalesce(CASE WHEN fate = 0 THEN 'X' || substr(html, 2) ELSE html END, '') AS copy FROM fates),
        heads AS (
            SELECT *, 'WARC/1.1' || chr(13) || chr(10) || 'WARC-Type: resource' || chr(13) || chr(10)
                   || 'WARC-Record-ID: <urn:page:' || coalesce(page_id::VARCHAR, '') || '>' || chr(13) || chr(10)
                   || 'WARC-Target-URI: ' || coalesce(url, '') || chr(13) || chr(10)
                   || 'Content-Type: text/html' || chr(13) || chr(10) || 'Content-Length: ' AS head,
                   chr(13) || chr(10) || chr(13) || chr(10) AS gap FROM bodies),
        records AS (
            SELECT page_id, fate, head || strlen(body) || gap || body || gap AS one,
                   head || strlen(copy) || gap || copy || gap AS two FROM heads),
        hashed AS (
            SELECT page_id, fate, strlen(one)::BIGINT AS n_bytes, sha256(one) AS sha256, sha256(two) AS there
            FROM records),
        placed AS (
            SELECT *, (('0x' || substr(md5(sha256), 1, 8))::BIGINT % (SELECT greatest(1, (sum(n_bytes) + 16777215) // 16777216)
                       FROM hashed))::INTEGER AS file FROM hashed)
        SELECT page_id, file, coalesce(sum(n_bytes) OVER (PARTITION BY file ORDER BY page_id NULLS FIRST, sha256
                   ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS record_offset, n_bytes, sha256,
               CASE WHEN fate != 1 THEN there END AS replica_sha256,
               CASE WHEN fate = 1 THEN 'missing' WHEN there != sha256 THEN 'changed' ELSE 'same' END AS status
        FROM placed""",
    "op11_lexical_search": r"""
        WITH dw AS (
            SELECT doc_id, row_number() OVER () AS row, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                   'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
        iw AS (
            SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                   'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS t FROM benchmark),
        corpus AS (SELECT count(*) AS docs, sum(len(w))::BIGINT AS words FROM dw WHERE len(w) > 0),
        tf AS (
            SELECT doc_id, row, n, t, count(*) AS tf FROM (SELECT doc_id, row, len(w) AS n, unnest(w) AS t FROM dw)
            WHERE t IN (SELECT t FROM iw) GROUP BY doc_id, row, n, t),
        weights AS (
            SELECT t, floor(1000 * ln((2 * docs + 2) / (2 * df + 1)))::BIGINT AS weight
            FROM (SELECT t, count(*) AS df FROM tf GROUP BY t), corpus),
        scores AS (
            SELECT item_id, doc_id, row,
                   sum(weight * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * docs) // words))))::BIGINT AS score
            FROM iw JOIN weights USING (t) JOIN tf USING (t), corpus GROUP BY item_id, doc_id, row),
        ranked AS (
            SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank, doc_id, score
            FROM scores WHERE score > 0)
        SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 50""",
    "op13_bottom_k": r"""
        WITH RECURSIVE words AS (
            SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                   'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
        sets AS (
            SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 2 THEN [w]
                   ELSE list_transform(range(1, len(w)), lambda i: w[i:i + 1]) END) AS s FROM words),
        members AS (SELECT doc_id, len(s) AS n, hash(unnest(s)) AS h FROM sets),
        pairs AS (
            SELECT a.doc_id AS x, b.doc_id AS y FROM members a JOIN members b ON a.h = b.h AND a.doc_id != b.doc_id
            GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))),
        reach(x, y) AS (
            SELECT doc_id, doc_id FROM sets UNION SELECT r.x, p.y FROM reach r JOIN pairs p ON r.y = p.x),
        least AS (SELECT x, min(y) AS component_id FROM reach GROUP BY x)
        SELECT s.doc_id, len(s.s)::BIGINT AS n_shingles, component_id, s.doc_id = component_id AS kept
        FROM sets s JOIN least l ON s.doc_id = l.x""",
}
