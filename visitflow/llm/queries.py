"""Registered queries of the training-data operators and their DuckDB SQL."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, conversations, exact_dedup, hard_negatives, line_dedup, mixing, pii, quality, secrets, sharding, simhash, toxicity, url_filter
from .common import documents, table, text_hash


def op3_merge_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = bpe.load_vocabulary(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    return bpe.encode(documents(spark, sf_dir).select("doc_id", "text"), v, ids=None, digests=True).drop("text")


def op4_automaton(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.find_secrets(documents(spark, sf_dir).select("doc_id", "text")).drop("text")
    return secrets.span_report(found, "secret_spans", secrets.BASE_KINDS)


# target shares go with (tokens of the value) ** exponent
MIX_EXPONENTS = {"source": 0.8, "lang": 0.8, "topic": 0.9}


def op5_raked_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "source", "lang", mixing.style_topic().alias("topic"),
                                           mixing.word_count().alias("words"), text_hash("text").alias("text_key"))
    rows, names = mixing.mix(docs, MIX_EXPONENTS, F.col("words"), content=F.col("text_key"))
    return rows.select("doc_id", "source", "lang", "topic", *names.values())


def op6_skip_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find_personal_data(documents(spark, sf_dir).select("doc_id", "text")).drop("text")
    return secrets.span_report(found, "pii_spans", pii.KINDS)


def op7_simhash_bktree(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = simhash.simhash_groups(documents(spark, sf_dir))
    return groups.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op1_line_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    rows, (*_, n, dropped, keepers) = line_dedup.with_dropped(docs, line_dedup.dropped_lines(docs, width=line_dedup.NEAR_SHINGLE))
    none = F.array().cast("array<bigint>")
    return rows.select("doc_id", F.coalesce(F.col(n), F.lit(0)).alias("n_lines"),
                       F.coalesce(F.size(F.col(dropped)), F.lit(0)).cast("long").alias("n_dropped"),
                       F.coalesce(F.array_join(F.col(dropped), ","), F.lit("")).alias("dropped_lines"),
                       F.coalesce(F.col(keepers), none).alias("kept_docs"))


def op2_histogram_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = documents(spark, sf_dir).select(
        "doc_id", (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"), F.xxhash64(text).alias("text_key"))
    dealt = sharding.histogram_shards(rows, ["text_key"], ["doc_id"], "size", shards=16)
    return dealt.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                        F.lit(None).cast("int").alias("grown_shard"))


def op8_block_naming(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(documents(spark, sf_dir))


def op9_noisy_channel(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(documents(spark, sf_dir), table(spark, sf_dir, "labels"))


def op10_decision_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, _ = quality.quality(documents(spark, sf_dir), table(spark, sf_dir, "labels"))
    return rows.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
                       "kept", "rule")


# (host, path, verdict): fixed values of the query's contract
URL_RULES = (("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow"))


def op11_url_vocabulary(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    rows, names = url_filter.judge_urls(pages, rules=URL_RULES)
    return rows.select("page_id", *names.values())


def op12_segment_summaries(spark: SparkSession, sf_dir: str) -> DataFrame:
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.hard_negatives(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, label=moved)


def op13_secondary_sort(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = conversations.damaged(table(spark, sf_dir, "conversations"))
    return conversations.repair_report(rows, lost=F.col("lost"))


OP8_SQL = r"""
WITH norm AS (
  SELECT doc_id, length(coalesce(text, '')) AS chars,
         sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', '', 'g')) AS text_sha256
  FROM documents),
ranked AS (
  SELECT *, count(*) OVER (PARTITION BY text_sha256) AS group_size,
         first_value(doc_id) OVER (PARTITION BY text_sha256 ORDER BY chars DESC, doc_id) AS keep_id
  FROM norm)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM ranked
"""

_TERM_END = "[^a-z0-9]"
OP11_SQL = f"""
WITH parts AS (
  SELECT page_id, translate(coalesce(url, ''), '{url_filter.UPPER}', '{url_filter.LOWER}') AS u,
         translate(coalesce(regexp_extract(url, '{url_filter.PARTS}', 1), ''), '{url_filter.UPPER}', '{url_filter.LOWER}') AS host,
         coalesce(regexp_extract(url, '{url_filter.PARTS}', 2), '') AS path
  FROM pages),
ruled AS (
  SELECT *, CASE {" ".join(
      f"WHEN (host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}') THEN '{h}{p}'"
      for h, p, _ in sorted(URL_RULES, key=lambda r: -len(r[0] + r[1])))} END AS rule
  FROM parts),
-- signs are doubled first, so that neighbouring hits need not share one
counted AS (
  SELECT *, {" + ".join(f"len(regexp_extract_all(' ' || regexp_replace(u, '({_TERM_END})', '\\1\\1', 'g') || ' ', '{_TERM_END}{t}{_TERM_END}'))" for t in url_filter.STRICT_TERMS)} AS strict_hits,
         {" + ".join(f"CAST(regexp_matches(u, '(^|{_TERM_END}){t}({_TERM_END}|$)') AS BIGINT)" for t in url_filter.SOFT_TERMS)} AS soft_hits
  FROM ruled)
SELECT page_id, host, path, rule,
       CASE {" ".join(f"WHEN rule = '{h}{p}' THEN '{v}'" for h, p, v in URL_RULES)}
            WHEN strict_hits > 0 OR soft_hits >= {url_filter.SOFT_LIMIT} THEN 'block' ELSE 'allow' END AS verdict,
       strict_hits, soft_hits
FROM counted
"""

OP12_SQL = """
WITH rows AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same,
         CAST(list_inner_product(a.v, b.v) AS BIGINT) AS score
  FROM rows a JOIN rows b ON a.vec_id != b.vec_id WHERE a.vec_id % 100 = 0),
positives AS (
  SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5)
SELECT p.anchor_id, p.positive_id, CAST(row_number() OVER w AS INTEGER) AS rank, s.other_id AS negative_id,
       p.positive_score, s.score AS negative_score
FROM positives p JOIN scored s ON s.anchor_id = p.anchor_id AND NOT s.same
  AND 80 * p.positive_score <= 100 * s.score AND s.score <= p.positive_score
WINDOW w AS (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.other_id)
QUALIFY row_number() OVER w <= 5
"""


def queries() -> dict:
    return {f.__name__: f for f in (op1_line_minhash, op2_histogram_shards, op3_merge_replay, op4_automaton, op5_raked_mix, op6_skip_chain,
                                  op7_simhash_bktree, op8_block_naming, op9_noisy_channel, op10_decision_list, op11_url_vocabulary,
                                  op12_segment_summaries, op13_secondary_sort)}


def oracle_sql() -> dict[str, str]:
    return {"op8_block_naming": OP8_SQL, "op11_url_vocabulary": OP11_SQL,
            "op12_segment_summaries": OP12_SQL}
