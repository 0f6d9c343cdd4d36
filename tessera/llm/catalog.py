"""The operators' queries over the driver's tables, and DuckDB SQL for those that SQL can express."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import ann, bpe, chat, katz, media, mixing, quality, sharding, simhash, warc

#: The tokenizer of op6; a parameter of the operator.
TOKENIZER = "byte_bpe_50k.json"
SHARDS = 8


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.components(table(spark, sf_dir, "documents"))


def fitted(spark: SparkSession, docs: DataFrame, sf_dir: str) -> quality.Model:
    """The classifier of documents that are good (quality 1) and fit for use (toxic 0)."""
    return quality.fit(docs, table(spark, sf_dir, "labels"), (F.col("quality") == 1) & (F.col("toxic") == 0))


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality.classify(docs, fitted(spark, docs, sf_dir))


def op3_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    ours = spark.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit("</s>[INST] ok [/INST]").alias("text"),
    )
    events = chat.as_streams(chat.as_events(turns.unionByName(ours)))  # deltas, edits and regenerations, to be folded
    return chat.digests(chat.render(chat.fold(events)))


def op4_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.search(table(spark, sf_dir, "embeddings"), F.col("id") % 20 == 0)


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    mixed = mixing.mix(docs, mixing.rates(docs))
    return mixed.select("doc_id", "source", F.round("rate", 6).alias("rate"), "n_copies", "copy", "shuffle_key")


def op6_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER))


def op7_katz(spark: SparkSession, sf_dir: str) -> DataFrame:
    return katz.score(table(spark, sf_dir, "documents"))


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    packages = warc.write(table(spark, sf_dir, "pages"))
    return warc.read(packages, payloads=False).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op9_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    return media.digests(table(spark, sf_dir, "documents"))


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", (F.octet_length(text).cast("long") + 1).alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"))
    return sharding.interleave(docs, SHARDS).select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


QUERIES = {f.__name__: f for f in (op1_simhash, op2_quality, op3_chat, op4_ann, op5_mixing, op6_bpe, op7_katz, op8_warc, op9_media, op10_sharding)}

ORACLES: dict[str, str] = {}

ORACLES["op3_chat"] = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'
), lens AS (
  SELECT *, length('[INST][/INST]</s>')
    + length(regexp_replace(role, '([\[<])(\\*(?:/?INST\]|/s>))', '\1\\\2', 'g'))
    + length(regexp_replace(text, '([\[<])(\\*(?:/?INST\]|/s>))', '\1\\\2', 'g')) AS n
  FROM turns
), whole AS (
  SELECT conv_id, count(*) AS n_turns,
    string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text) AS said,
    coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, text) FILTER (WHERE role = 'assistant'), '') AS loss,
    CAST(sum(n) AS BIGINT) AS formatted_chars
  FROM lens GROUP BY conv_id
)
SELECT conv_id, n_turns, sha256(said) AS turns_sha256, length(loss) AS loss_chars, sha256(loss) AS loss_sha256, formatted_chars FROM whole
"""

ORACLES["op5_mixing"] = f"""
WITH sized AS (
  SELECT coalesce('v' || source, 'n') AS s, sum(coalesce(strlen(text), 0) + 1)::DOUBLE AS size FROM documents GROUP BY 1
), rates AS (
  SELECT s, pow(size, {mixing.TEMPERATURE}) / sum(pow(size, {mixing.TEMPERATURE})) OVER () * sum(size) OVER () / size AS rate FROM sized
), steps AS (
  SELECT s, rate, unnest(range(0, CAST(ceil(rate + 12 * sqrt(rate) + 30) AS BIGINT) + 1)) AS k FROM rates
), mass AS (
  SELECT s, rate, k, exp(sum(CASE WHEN k > 0 THEN ln(rate) - ln(k) ELSE 0 END) OVER (PARTITION BY s ORDER BY k) - rate) AS mass FROM steps
), cdf AS (
  SELECT s, rate, k, sum(mass) OVER (PARTITION BY s ORDER BY k) AS upto FROM mass
), drawn AS (
  SELECT doc_id, source, coalesce('v' || source, 'n') AS s,
    CAST('0x' || substr(md5('v{mixing.SEED}' || chr(31) || 'v' || doc_id || chr(31) || 'n'), 1, 13) AS BIGINT) / pow(16, 13) AS u
  FROM documents
), counted AS (
  SELECT d.doc_id, d.source, c.rate, count(*) FILTER (WHERE c.upto <= d.u) AS n FROM (SELECT row_number() OVER () AS r, * FROM drawn) d JOIN cdf c USING (s) GROUP BY d.r, d.doc_id, d.source, c.rate
)
SELECT doc_id, source, round(rate, 6) AS rate, CAST(n AS INTEGER) AS n_copies, CAST(copy AS INTEGER) AS copy,
  md5('v{mixing.SEED + 1}' || chr(31) || 'v' || doc_id || chr(31) || 'n' || chr(31) || 'v' || copy) AS shuffle_key
FROM (SELECT *, unnest(range(1, n + 1)) AS copy FROM counted WHERE n > 0)
"""

#: SHA-1 in base 32: the 40 hex digits as 160 bits, five at a time.
ORACLES["op8_warc"] = """
WITH p AS (
  SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages
), h AS (
  SELECT page_id, octet_length(payload) AS payload_bytes, sha1(payload) AS hex FROM p
), f AS (
  SELECT *, min(page_id) OVER (PARTITION BY hex) AS first,
    array_to_string(list_transform(range(1, 41), lambda i: lpad(bin(CAST('0x' || substr(hex, i, 1) AS INTEGER)), 4, '0')), '') AS bits
  FROM h
)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes,
  array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + list_sum(list_transform(range(0, 5), lambda b: CAST(substr(bits, CAST(5 * i + b + 1 AS INTEGER), 1) AS INTEGER) * CAST(pow(2, 4 - b) AS INTEGER)))::INTEGER, 1)), '') AS payload_digest,
  CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> first THEN first END AS refers_to
FROM f
"""
