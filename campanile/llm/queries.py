"""Queries over whole tables, one for each operator, and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from campanile.llm import (bpe, conversation_repair, hard_negatives, html_text, jaccard_join, langid, license_scan, maxent_lm, mixing,
                           quality_rules, top_k, toxicity, url_filter)
from campanile.llm.sample import bounded, crc


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_language_id(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents")
    held_out = F.pmod(crc(), F.lit(3)) == 1
    model = langid.fit(docs.filter(~held_out))
    return langid.predict(docs.withColumn("held_out", held_out), model, "doc_id", "held_out")


def op2_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    return quality_rules.judge(_table(spark, folder, "documents"))


def op3_maxent_lm(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents").select("doc_id", "text", (F.pmod(crc(), F.lit(10)) == 0).alias("held_out"))
    training = docs.filter(~F.coalesce("held_out", F.lit(False)))
    counts = maxent_lm.token_counts(training)
    words = maxent_lm.vocabulary(counts)
    weights = maxent_lm.train(training, words)
    return maxent_lm.score(docs, counts, words, weights, "doc_id", "held_out")


def op4_byte_level_bpe(spark: SparkSession, folder: str) -> DataFrame:
    import public_tokenizers

    ranks = bpe.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    encoded = bpe.encode(_table(spark, folder, "documents"), ranks, public_tokenizers.PATTERN, "doc_id")
    decoded = bpe.decode(encoded, ranks, "doc_id", "ids")
    return decoded.select("doc_id", F.expr("cast(octet_length(ids) div 4 as bigint)").alias("n_tokens"),
                          F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op5_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    return license_scan.scan(_table(spark, folder, "documents"))


def op6_exact_top_k(spark: SparkSession, folder: str) -> DataFrame:
    vectors = _table(spark, folder, "embeddings")
    return top_k.top_k(vectors, vectors.filter("vec_id % 100 = 0"), 10)


def toxicity_model(docs: DataFrame, labels: DataFrame) -> toxicity.ToxicityModel:
    """Fitted on the labels outside the held-out fold."""
    known = labels.select("doc_id", "toxic").filter("toxic IN (0, 1)").filter(F.pmod(crc(), F.lit(5)) != 0)
    # The sample's size is bounded, so it may be broadcast, and no text is shuffled.
    sample = bounded(known, toxicity.MAX_LABELLED)
    return toxicity.fit(docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id"))


def op7_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents")
    model = toxicity_model(docs, _table(spark, folder, "labels"))
    held_out = docs.withColumn("held_out", F.pmod(crc(), F.lit(5)) == 0)
    return toxicity.score(held_out, model, "doc_id", "held_out").drop("passages")


def op8_html_extraction(spark: SparkSession, folder: str) -> DataFrame:
    pages = _table(spark, folder, "pages")
    return html_text.extract(pages, html_text.fit(pages), "page_id", "url")


def op9_mix_sources(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mix(_table(spark, folder, "documents"))


def op10_ngram_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard_join.jaccard_components(_table(spark, folder, "documents"))


def op11_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    return url_filter.judge_urls(_table(spark, folder, "pages"))


def op12_conversation_repair(spark: SparkSession, folder: str) -> DataFrame:
    conversations = _table(spark, folder, "conversations")
    return conversation_repair.repair(conversation_repair.damaged(conversations), conversations)


def op13_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    return hard_negatives.mine(_table(spark, folder, "embeddings"))


def all_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_language_id, op2_quality_rules, op3_maxent_lm, op4_byte_level_bpe, op5_license_scan, op6_exact_top_k,
                                    op7_toxicity, op8_html_extraction, op9_mix_sources, op10_ngram_jaccard_join,
                                    op11_url_filter, op12_conversation_repair, op13_hard_negatives)}


def all_sql() -> dict[str, str]:
    return {"op2_quality_rules": quality_rules.SQL, "op5_license_scan": license_scan.SQL,
            "op11_url_filter": url_filter.SQL, "op13_hard_negatives": hard_negatives.SQL}
