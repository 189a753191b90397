"""The queries of this subpackage and, where SQL can say them, their oracles."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillage.llm.ann import nearest
from tillage.llm.bpe import bpe_encode
from tillage.llm.common import table
from tillage.llm.conversation_repair import damage, repair_conversations
from tillage.llm.decontaminate import flag_contaminated
from tillage.llm.line_dedup import line_dedup
from tillage.llm.minhash import near_duplicates
from tillage.llm.spelling import spelling_variants
from tillage.llm.substring_dedup import substring_dedup
from tillage.llm.suffix_dedup import suffix_dedup
from tillage.llm.token_files import token_files
from tillage.llm.toxicity import fit_toxicity, score_toxicity
from tillage.llm.url_filter import filter_urls
from tillage.llm.warc import warc_captures

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def _query(key: str, sql: str | None = None):
    def register(job):
        QUERIES[key] = job
        if sql:
            ORACLES[key] = sql
        return job

    return register


def tokenizer(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@_query("op2_line_dedup", r"""
WITH lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos FROM documents),
keyed AS (SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k FROM lines),
common AS (SELECT k, max(doc_id) AS keeper FROM keyed WHERE length(k) >= 20 GROUP BY k HAVING count(DISTINCT doc_id) >= 3),
marked AS (SELECT keyed.*, coalesce(doc_id <> keeper, false) AS lost FROM keyed LEFT JOIN common USING (k))
SELECT doc_id, count(*)::BIGINT AS n_lines, count(*) FILTER (lost)::BIGINT AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT lost), '')) AS kept_sha256
FROM marked GROUP BY doc_id""")
def op2(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return line_dedup(docs).select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


@_query("op1_suffix_dedup")
def op1(spark: SparkSession, folder: str) -> DataFrame:
    return suffix_dedup(table(spark, folder, "documents"), texts=False)


@_query("op5_substring_dedup")
def op5(spark: SparkSession, folder: str) -> DataFrame:
    return substring_dedup(table(spark, folder, "documents"), texts=False)


@_query("op3_decontamination")
def op3(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    flagged = flag_contaminated(docs, table(spark, folder, "benchmark"))
    return flagged.where("contaminated").select("doc_id", "item_id", "overlap", "contaminated")


@_query("op4_minhash")
def op4(spark: SparkSession, folder: str) -> DataFrame:
    return near_duplicates(table(spark, folder, "documents"), percent=85, shingle=3)


@_query("op6_ann")
def op6(spark: SparkSession, folder: str) -> DataFrame:
    return nearest(table(spark, folder, "embeddings"))


def held_out(doc_id="doc_id"):
    return F.crc32(F.col(doc_id).cast("string")) % 4 == 2


def toxicity_model(spark: SparkSession, folder: str):
    labels = table(spark, folder, "labels").where(~held_out())
    return fit_toxicity(table(spark, folder, "documents"), labels)


@_query("op7_toxicity")
def op7(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    scored = score_toxicity(docs, toxicity_model(spark, folder))
    return scored.select("doc_id", F.coalesce(held_out(), F.lit(False)).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


# the rule list of the query, a fixed value
URL_RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]


@_query("op8_url_filter", r"""
WITH rest AS (SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS r FROM pages),
raw AS (SELECT page_id, r, regexp_extract(r, '^[^/?#]*') AS h FROM rest),
parts AS (SELECT page_id, translate(h, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host, regexp_extract(substr(r, length(h) + 1), '^[^?#]*') AS path FROM raw),
judged AS (SELECT *, CASE
  WHEN (host = 'example.net' OR ends_with(host, '.example.net')) AND starts_with(path, '/en/') THEN 'example.net/en/'
  WHEN (host = 'example.com' OR ends_with(host, '.example.com')) AND starts_with(path, '/de/') THEN 'example.com/de/'
  WHEN (host = 'org' OR ends_with(host, '.org')) AND starts_with(path, '/fr/') THEN 'org/fr/'
  WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/') THEN 'net/' END AS rule FROM parts)
SELECT page_id, host, path, rule, CASE WHEN rule IN ('net/', 'example.com/de/') THEN 'block' ELSE 'allow' END AS verdict FROM judged""")
def op8(spark: SparkSession, folder: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return filter_urls(table(spark, folder, "pages"), rules)


@_query("op9_bpe")
def op9(spark: SparkSession, folder: str) -> DataFrame:
    return bpe_encode(table(spark, folder, "documents"), tokenizer("word_bpe_49k.json"), digests=True)


@_query("op10_token_files")
def op10(spark: SparkSession, folder: str) -> DataFrame:
    return token_files(table(spark, folder, "documents"), tokenizer("byte_bpe_50k.json"))


@_query("op11_spelling")
def op11(spark: SparkSession, folder: str) -> DataFrame:
    return spelling_variants(table(spark, folder, "documents"))


@_query("op12_warc", """
WITH bodies AS (SELECT page_id, url, coalesce(html, '') AS body FROM pages),
known AS (SELECT *, octet_length(encode(body))::BIGINT AS n, min(page_id) OVER (PARTITION BY body) AS first FROM bodies)
SELECT page_id, n AS payload_bytes, sha256(body) AS payload_digest,
  CASE WHEN n >= 100 AND page_id IS DISTINCT FROM first THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN n >= 100 AND page_id IS DISTINCT FROM first THEN first END AS refers_to
FROM known""")
def op12(spark: SparkSession, folder: str) -> DataFrame:
    return warc_captures(table(spark, folder, "pages")).drop("capture")


@_query("op13_conversation_repair")
def op13(spark: SparkSession, folder: str) -> DataFrame:
    return repair_conversations(damage(table(spark, folder, "conversations")), texts=False).drop("repaired")
