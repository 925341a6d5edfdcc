"""The numbered queries and the SQL they are checked against where SQL can say it."""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barloom.llm import (
    exact_dedup, fill_in_middle, html_text, language_id, mixing, near_dedup, packing, ppm, sentence_pieces, syncmers,
    token_files, warc, whitening,
)
from barloom.llm.common import id_crc, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_exact_dedup(spark, sf_dir):
    return exact_dedup.exact_groups(table(spark, sf_dir, "documents").select("doc_id", "text"))


ORACLES["op1_exact_dedup"] = """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))"""


@query
def op3_mixing(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return mixing.mix(docs, ["doc_id"]).drop("copies")


ORACLES["op3_mixing"] = r"""
WITH d AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS size,
         md5('7:' || coalesce(doc_id::VARCHAR, '')) AS mark
  FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
w AS (
  SELECT *, CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight
  FROM s),
p AS (
  SELECT *, row_number() OVER o AS k, 3 * source_size / weight AS ratio,
         (sum(3 * source_size) OVER o)::BIGINT AS capped, (sum(weight) OVER ())::BIGINT - (sum(weight) OVER o)::BIGINT AS free,
         (sum(source_size) OVER ())::BIGINT AS total
  FROM w WINDOW o AS (ORDER BY 3 * source_size / weight, source NULLS LAST)),
levels AS (
  SELECT 0 AS k, total / (SELECT sum(weight) FROM w)::BIGINT AS level FROM p WHERE k = 1
  UNION ALL SELECT k, (total - capped) / free FROM p WHERE free > 0),
chosen AS (
  SELECT level FROM levels l
  WHERE level <= coalesce((SELECT min(ratio) FROM p WHERE p.k > l.k), level) ORDER BY k LIMIT 1),
t AS (SELECT source, source_size, round(least(weight * level, 3 * source_size), 6) AS target FROM p, chosen),
c AS (
  SELECT doc_id, size, source_size, target, CASE WHEN source_size > 0 THEN floor(target / source_size)::BIGINT ELSE 0 END AS whole,
         (sum(size) OVER (PARTITION BY d.source ORDER BY mark, size ROWS UNBOUNDED PRECEDING))::BIGINT - size AS start
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
       size * (whole + (2 * start + size < 2 * (target - whole * source_size))::INT) AS taken
FROM c"""


@query
def op2_language_id(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "text")
    held_out = id_crc() % 5 == 0
    model = language_id.training_text(docs, ~held_out)
    return language_id.predict(docs.withColumn("held_out", held_out), model, ["doc_id", "held_out"]).select(
        "_row.*", "lang_pred", "score"
    )


@query
def op5_token_files(spark, sf_dir):
    return token_files.token_files(table(spark, sf_dir, "documents").select("doc_id", "text"))


@query
def op6_packing(spark, sf_dir):
    return packing.pack(table(spark, sf_dir, "documents").select("doc_id", "text"))


@query
def op8_syncmers(spark, sf_dir):
    return syncmers.fingerprints(table(spark, sf_dir, "documents").select("doc_id", "text"))


@query
def op9_warc(spark, sf_dir):
    return warc.archive(table(spark, sf_dir, "pages").select("page_id", "url", "html")).drop("url")


ORACLES["op9_warc"] = """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages),
d AS (SELECT page_id, octet_length(payload) AS payload_bytes, sha256(payload) AS payload_digest FROM p),
f AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first_id FROM d),
r AS (SELECT *, CASE WHEN payload_bytes >= 100 AND page_id > first_id THEN first_id END AS refers_to FROM f)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN refers_to IS NULL THEN 'response' ELSE 'revisit' END AS record_type, refers_to
FROM r"""


@query
def op10_near_dedup(spark, sf_dir):
    return near_dedup.near_classes(table(spark, sf_dir, "documents").select("doc_id", "text"))


@query
def op7_ppm(spark, sf_dir):
    return ppm.ppm_scores(table(spark, sf_dir, "documents").select("doc_id", "text"))


@query
def op4_html_text(spark, sf_dir):
    return html_text.extract(table(spark, sf_dir, "pages").select("page_id", "url", "html"))


@query
def op11_pieces(spark, sf_dir):
    encoded = sentence_pieces.encode(table(spark, sf_dir, "documents"), ["doc_id"], decoded=True)
    decimal = F.array_join(F.col("ids").cast("array<string>"), ",")
    return encoded.select(
        "_row.*", F.size("ids").cast("long").alias("n_tokens"), F.sha2(decimal.cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


@query
def op12_fill_in_middle(spark, sf_dir):
    moved = fill_in_middle.fill_in_middle(table(spark, sf_dir, "documents"), ["doc_id"])
    return moved.select(
        "_row.*", "n", "form", "prefix_chars", "middle_chars", F.sha2(F.col("output").cast("binary"), 256).alias("output_sha256"),
        F.sha2(fill_in_middle.restored(F.col("output"), F.col("form")).cast("binary"), 256).alias("restored_sha256"),
    )


ORACLES["op12_fill_in_middle"] = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS body, sha256('42:' || coalesce(doc_id::VARCHAR, '')) AS digest,
         regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS units
  FROM documents),
h AS (
  SELECT *, len(units) AS n, ('0x' || digest[1:8])::BIGINT AS h1, ('0x' || digest[9:16])::BIGINT AS h2,
         ('0x' || digest[17:24])::BIGINT AS h3, ('0x' || digest[25:32])::BIGINT AS h4 FROM d),
c AS (
  SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
         CASE WHEN body = '' OR contains(body, '<P>') OR contains(body, '<S>') OR contains(body, '<M>') OR h3 % 100 >= 50 THEN 'plain'
              WHEN h4 % 100 < 80 THEN 'spm' ELSE 'psm' END AS form FROM h),
p AS (
  SELECT *, array_to_string(units[1:a], '') AS prefix, array_to_string(units[a + 1:b], '') AS middle,
         array_to_string(units[b + 1:n], '') AS suffix FROM c)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN body WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                        ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
       sha256(body) AS restored_sha256
FROM p"""


@query
def op13_whitening(spark, sf_dir):
    white = whitening.whitened_components(table(spark, sf_dir, "embeddings"), ["vec_id"])
    return white.select(
        "_row.*", "component", "n", F.col("deviation").cast("long").alias("deviation"), "whitened", "explained", "identity_error"
    )
