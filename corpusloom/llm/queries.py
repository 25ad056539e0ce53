"""Registered queries of the subpackage; each applies its operator to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.llm import (
    bagminhash, chat, hard_negatives, language, mixing, neighbours, perplexity, pieces, repair, secret_scan, suffix_dedup,
    token_counts, url_filter,
)


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


def op1_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents")
    return token_counts.token_counts(docs, tokenizer_path("word_bpe_49k.json"), limit=2048)


def op2_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    found = secret_scan.scan(_table(spark, folder, "documents"))
    return found.select("doc_id", "nth", F.sha2("value", 256).alias("value_sha256"), F.length("value").alias("length"), "score", "secret")


def op3_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    return perplexity.quality_rules(_table(spark, folder, "documents"))


def op4_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    return neighbours.nearest(_table(spark, folder, "embeddings"), every=50, k=5)


def op5_pieces(spark: SparkSession, folder: str) -> DataFrame:
    model = pieces.read_model(spark, tokenizer_path("piece_bpe_32k.model"))
    return pieces.encode_documents(_table(spark, folder, "documents"), model, keep=["doc_id"])


#: Rules of the URL list, and their verdicts.
URL_RULES = (("org/", "allow"), ("example.org/es/", "block"), ("example.org/en/1", "block"), ("com/fr/", "allow"), ("com/de/", "block"))


def op6_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    return url_filter.judge_urls(_table(spark, folder, "pages"), URL_RULES)


def op7_language(spark: SparkSession, folder: str) -> DataFrame:
    return language.identify(_table(spark, folder, "documents"))


def op8_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mix_counts(_table(spark, folder, "documents"))


def op9_bagminhash(spark: SparkSession, folder: str) -> DataFrame:
    return bagminhash.near_duplicates(_table(spark, folder, "documents"))


def op10_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return suffix_dedup.remove_repeats(_table(spark, folder, "documents"), length=200).drop("spans")


def op11_conversation_repair(spark: SparkSession, folder: str) -> DataFrame:
    repaired = repair.repair(repair.damage(_table(spark, folder, "conversations")))
    return repaired.withColumnRenamed("conv", "conv_id")


def op12_chat_format(spark: SparkSession, folder: str) -> DataFrame:
    rows = _table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    conv, text = chat.PLANTED
    planted = spark.createDataFrame([(conv, 0, "user", text), (conv, 1, "assistant", text)], rows.schema)
    return chat.read_back(chat.format_turns(rows.union(planted)))


def op13_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    return hard_negatives.mine(_table(spark, folder, "embeddings"), label_rule=hard_negatives.moved_labels())


QUERIES = {
    "op1_token_counts": op1_token_counts,
    "op2_secret_scan": op2_secret_scan,
    "op3_quality_rules": op3_quality_rules,
    "op4_neighbours": op4_neighbours,
    "op5_pieces": op5_pieces,
    "op6_url_filter": op6_url_filter,
    "op7_language": op7_language,
    "op8_mixing": op8_mixing,
    "op9_bagminhash": op9_bagminhash,
    "op10_suffix_dedup": op10_suffix_dedup,
    "op11_conversation_repair": op11_conversation_repair,
    "op12_chat_format": op12_chat_format,
    "op13_hard_negatives": op13_hard_negatives,
}

ORACLES: dict[str, str] = {
    "op8_mixing": mixing.ORACLE,
    "op11_conversation_repair": repair.ORACLE,
    "op12_chat_format": chat.ORACLE,
    "op13_hard_negatives": hard_negatives.ORACLE,
}
