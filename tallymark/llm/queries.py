"""The queries of this package, each one operator over its whole table, and their SQL twins."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallymark.llm import (
    ann,
    chat,
    codes,
    language,
    mixing,
    neardup,
    packing,
    quality,
    repair,
    sharding,
    sqltext,
    tokens,
    urls,
    warc,
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    ours = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame(
        [(-7, 0, "user", ours), (-7, 1, "assistant", ours)], "conv_id long, turn long, role string, text string"
    )
    return chat.digests(chat.format_chats(turns.unionByName(extra)))


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality.score(docs, quality.fit(docs, table(spark, sf_dir, "labels")))


def op3_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify(table(spark, sf_dir, "documents"))


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive_round_trip(table(spark, sf_dir, "pages"))


def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge(table(spark, sf_dir, "pages"))


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), added=True)


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    planned = mixing.plan(table(spark, sf_dir, "documents"))
    return planned.select("doc_id", "size", "source_size", "target", "taken")


def op8_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = neardup.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_shingles", "component_id", "kept")


def op9_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(table(spark, sf_dir, "documents"))


def op10_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return codes.compress(table(spark, sf_dir, "embeddings"))


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair.report(repair.damage(table(spark, sf_dir, "conversations")))


def op13_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.count_tokens(table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_chat_format": op1_chat_format,
    "op2_quality_rules": op2_quality_rules,
    "op3_language": op3_language,
    "op4_warc": op4_warc,
    "op5_url_filter": op5_url_filter,
    "op6_packing": op6_packing,
    "op7_mixing": op7_mixing,
    "op8_near_duplicates": op8_near_duplicates,
    "op9_sharding": op9_sharding,
    "op10_nearest": op10_nearest,
    "op11_vector_codes": op11_vector_codes,
    "op12_conversation_repair": op12_conversation_repair,
    "op13_token_counts": op13_token_counts,
}

SQL = {
    "op1_chat_format": sqltext.CHATS,
    "op4_warc": sqltext.WARC,
    "op7_mixing": sqltext.MIXING,
    "op8_near_duplicates": sqltext.NEAR_DUPLICATES,
    "op11_vector_codes": sqltext.VECTOR_CODES,
    "op12_conversation_repair": sqltext.REPAIR,
}
