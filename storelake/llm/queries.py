"""The operators as registered queries over whole tables, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from storelake.llm import chat, decontam, filteraudit, lm, mixing, pii, repair, robust, sharding, simhash, tokencount, toxicity, urlfilter
from storelake.llm.common import prepared, table
from storelake.session import written


def op1_lm_scoring(spark: SparkSession, folder: str) -> DataFrame:
    return lm.scored(table(prepared(spark), folder, "documents"))


def op2_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    return robust.judged(table(prepared(spark), folder, "documents"))


def op3_sharding(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(prepared(spark), folder, "documents")
    checksum = F.crc32(F.encode(F.coalesce("text", F.lit("")), "UTF-8"))
    return sharding.sharded(docs).select(
        "doc_id",
        sharding.record_size().alias("size"),
        checksum.alias("text_crc32"),
        F.lit("key").alias("law"),
        "shard",
        "slot",
        sharding.shard_of(sharding.SHARDS + 1).alias("grown_shard"),
    )


def op4_near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    found = simhash.near_duplicates(table(prepared(spark), folder, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op5_chat_windows(spark: SparkSession, folder: str) -> DataFrame:
    turns = table(prepared(spark), folder, "conversations").select("conv_id", "turn", "role", "text")
    said = "</s>[INST] ok [/INST]"
    more = spark.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(said).alias("text"),
    )
    return chat.conversation_digests(chat.formatted(turns.unionByName(more)))


def op6_url_filters(spark: SparkSession, folder: str) -> DataFrame:
    return urlfilter.judged(table(prepared(spark), folder, "pages")).drop("listed")


def op7_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    import public_tokenizers

    docs, model = table(prepared(spark), folder, "documents"), public_tokenizers.path("piece_bpe_32k.model")
    counts = written(tokencount.token_counts(docs, model, stored=True), "prefix-counts")
    return counts.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > tokencount.LIMIT).alias("over_limit"), "fitting_chars")


def op8_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    prepared(spark)
    return decontam.contaminated(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def op9_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    prepared(spark)
    return toxicity.scored(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op10_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.taken_words(table(prepared(spark), folder, "documents"))


def op11_filter_audit(spark: SparkSession, folder: str) -> DataFrame:
    prepared(spark)
    return filteraudit.audit(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op12_personal_data(spark: SparkSession, folder: str) -> DataFrame:
    return pii.digests(pii.found_spans(table(prepared(spark), folder, "documents")))


def op13_conversation_repair(spark: SparkSession, folder: str) -> DataFrame:
    return repair.repaired(repair.damaged(table(prepared(spark), folder, "conversations")))


def pipeline(spark: SparkSession, folder: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, folder)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = (
        op1_lm_scoring,
        op2_quality_rules,
        op3_sharding,
        op4_near_duplicates,
        op5_chat_windows,
        op6_url_filters,
        op7_token_counts,
        op8_decontamination,
        op9_toxicity,
        op10_mixing,
        op11_filter_audit,
        op12_personal_data,
        op13_conversation_repair,
        pipeline,
    )
    return {f.__name__: f for f in found}


def oracle_sql() -> dict[str, str]:
    """DuckDB SQL of the queries that SQL can express; the others are tested against brute force."""
    return {"op6_url_filters": OP6_SQL, "op11_filter_audit": filteraudit.SQL}


# Rules by their text, then the listed host labels.
OP6_SQL = r"""
WITH parts AS (
    SELECT page_id,
           translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
           coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path
    FROM pages
), ruled AS (
    SELECT *,
           CASE WHEN ('.' || host) LIKE '%.www.example.com' AND starts_with(path, '/en/') THEN 'www.example.com/en/'
                WHEN ('.' || host) LIKE '%.example.com' AND starts_with(path, '/en/') THEN 'example.com/en/'
                WHEN ('.' || host) LIKE '%.net' AND starts_with(path, '/es/') THEN 'net/es/'
                WHEN ('.' || host) LIKE '%.net' AND starts_with(path, '/fr/') THEN 'net/fr/'
                WHEN ('.' || host) LIKE '%.com' AND starts_with(path, '/') THEN 'com/' END AS rule
    FROM parts
)
SELECT page_id, host, path, rule,
       CASE WHEN rule IN ('com/', 'www.example.com/en/') THEN 'allow'
            WHEN rule IS NOT NULL THEN 'block'
            WHEN len(list_intersect(string_split(host, '.'),
                 ['ads-track', 'adult-x', 'casino-win', 'cheap-pills', 'free-bets', 'spam-farm'])) > 0 THEN 'block'
            ELSE 'allow' END AS verdict
FROM ruled
"""
