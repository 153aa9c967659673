"""One query per operator over the whole of its table, and SQL counterparts where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from merchlens.llm import (
    chat, decontaminate, language, language_model, mixing, neighbours, quality, reputation, sharding, simhash, spelling,
    statements, token_alignment, warc,
)
from merchlens.llm.shared import read_table, remainder

Query = Callable[[SparkSession, str], DataFrame]

RULES = (("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/"))
PROBE = "</s>[INST] ok [/INST]"


def held_out(modulus: int, fold: int):
    return F.coalesce(remainder("doc_id", modulus) == fold, F.lit(False)).alias("held_out")


def op1_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    documents = read_table(spark, folder, "documents")
    model = quality.fit(documents, read_table(spark, folder, "labels"), learn=quality.training_rows())
    return quality.score(documents, model).select("doc_id", held_out(5, 0), "score", "predicted")


def op2_source_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mix(read_table(spark, folder, "documents"))


def op3_permutation_index(spark: SparkSession, folder: str) -> DataFrame:
    return neighbours.search(read_table(spark, folder, "embeddings"), F.col("vec_id") % 100 == 0)


def op4_language_model(spark: SparkSession, folder: str) -> DataFrame:
    found = language_model.score(read_table(spark, folder, "documents"), language_model.training_rows())
    return found.select("doc_id", held_out(5, 1), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op5_host_reputation(spark: SparkSession, folder: str) -> DataFrame:
    """Outcomes are those of the labelled document that a page shows: bad means toxic or of low quality."""
    bad = F.when((F.col("quality") == 0) | (F.col("toxic") == 1), 1).when(F.col("quality").isNotNull() | F.col("toxic").isNotNull(), 0)
    pages, documents = read_table(spark, folder, "pages"), read_table(spark, folder, "documents")
    outcomes = reputation.outcomes_of(pages, documents, read_table(spark, folder, "labels").select("doc_id", bad.alias("bad")))
    return reputation.judge(pages, outcomes, RULES).select("page_id", "host", "path", "rule", "verdict")


def op6_chat_format(spark: SparkSession, folder: str) -> DataFrame:
    turns = read_table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    probe = spark.createDataFrame([(-1, 0, "user", PROBE), (-1, 1, "assistant", PROBE)], "conv_id long, turn long, role string, text string")
    return chat.digests(chat.format_conversations(turns.unionByName(probe)))


def op7_simhash(spark: SparkSession, folder: str) -> DataFrame:
    found = simhash.near_duplicates(read_table(spark, folder, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op8_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    found = decontaminate.contaminated(read_table(spark, folder, "documents"), read_table(spark, folder, "benchmark"))
    return found.select("doc_id", "item_id", "score", "first_word", "end_word")


def op9_language_id(spark: SparkSession, folder: str) -> DataFrame:
    documents = read_table(spark, folder, "documents")
    model = language.fit(documents, learn=language.training_rows())
    return language.predict(documents, model).select("doc_id", held_out(3, 1), "lang_pred", "score")


def op10_warc(spark: SparkSession, folder: str) -> DataFrame:
    return warc.round_trip(read_table(spark, folder, "pages"))


def op11_spelling_variants(spark: SparkSession, folder: str) -> DataFrame:
    return spelling.group_variants(spelling.count_words(read_table(spark, folder, "documents")))


def op12_sharding(spark: SparkSession, folder: str) -> DataFrame:
    """The digests are those of the rows as they lie in the written shards."""
    rows = sharding.shuffle_files(spark, f"{folder}/documents.parquet")
    text = F.coalesce(F.col("row.text").cast("string").cast("binary"), F.lit(b""))
    return rows.select(
        F.col("row.doc_id").cast("long").alias("doc_id"), (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"), F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"),
    )


def op13_token_alignment(spark: SparkSession, folder: str) -> DataFrame:
    return token_alignment.align_tokenizers(read_table(spark, folder, "documents"))


def queries() -> dict[str, Query]:
    found = (
        op1_quality_classifier, op2_source_mixing, op3_permutation_index, op4_language_model, op5_host_reputation,
        op6_chat_format, op7_simhash, op8_decontamination, op9_language_id, op10_warc, op11_spelling_variants,
        op12_sharding, op13_token_alignment,
    )
    return {query.__name__: query for query in found}


def oracle_sql() -> dict[str, str]:
    """The other queries train models, hash with functions that other engines lack, draw at random or write files."""
    template = chat.Template()
    markup = {name: len(getattr(template, name)) for name in ("begin", "after_role", "between", "end")}
    return {
        "op5_host_reputation": statements.host_reputation(RULES),
        "op6_chat_format": statements.chat_format(PROBE, template.controls(), markup),
    }
