"""A corpus pipeline: drop toxic and poor documents, keep one of each group of near copies, mix the sources, encode."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from campanile.llm import bpe, jaccard_join, mixing, quality_rules, queries, toxicity
from campanile.llm.store import stored

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the model, fitted on the labels outside its held-out fold, doesn't call toxic; null and empty texts stay."""
    model = queries.toxicity_model(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.without_toxic(docs.select(*COLUMNS), model)


def drop_poor(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and aren't depleted by their host's frequent lines; texts stay whole."""
    return quality_rules.kept_documents(docs.select(*COLUMNS))


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of least id of each component; a document without an id stays, equal rows become one.

    Ids may repeat: a text goes if its own component has a smaller id, whatever other texts under its id do; of several
    texts of one id in one component the first by a hash of the text stays.
    """
    docs = docs.select(*COLUMNS)
    whole = F.xxhash64(F.coalesce("text", F.lit("")))
    # Where an id has several texts, the join sees a row for each id and text, under a number of its own.
    texts = stored(docs.filter("doc_id IS NOT NULL").select(F.col("doc_id").alias("id"), whole.alias("print"), "text").dropDuplicates(["id", "print"]), "texts")
    again = texts.groupBy("id").count().filter("count > 1").select(F.col("id").alias("again_id"))
    if again.isEmpty():
        found = jaccard_join.jaccard_components(docs).filter("doc_id <> component_id").select(F.col("doc_id").alias("out_id"))
        return docs.join(stored(found.distinct(), "components"), docs["doc_id"] == F.col("out_id"), "left_anti")
    keyed = stored(texts.withColumn("number", F.monotonically_increasing_id()), "numbered")
    found = jaccard_join.jaccard_components(keyed.select(F.col("number").alias("doc_id"), "text"))
    members = stored(found.select(F.col("doc_id").alias("number"), "component_id").join(keyed.drop("text"), "number"), "members")
    one = members.groupBy("component_id").agg(F.min(F.struct("id", "print")).alias("stays"))
    out = members.join(one, "component_id").filter(F.struct("id", "print") != F.col("stays")).select(
        F.col("id").alias("out_id"), F.col("print").alias("out_print"))
    rows = docs.withColumn("print", whole)
    kept = rows.join(out, (rows["doc_id"] == out["out_id"]) & (rows["print"] == out["out_print"]), "left_anti")
    with_id = kept.filter("doc_id IS NOT NULL").dropDuplicates(["doc_id", "print"])
    return with_id.unionByName(kept.filter("doc_id IS NULL")).select(*COLUMNS)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes their words, to the nearest whole time; 0 drops a document.

    Only the last document of a source is taken in part, so a source's words come near its target.
    """
    docs = docs.select(*COLUMNS)
    text_print = F.xxhash64("text", "source", "lang", "n_chars")
    taken = mixing.mix(docs.withColumn("print", text_print), "print")
    times = taken.filter("taken > 0").groupBy(F.col("doc_id").alias("id"), "print").agg(
        F.max(F.round(F.col("taken") / F.col("size")).cast("int")).alias("times")).filter("times > 0")
    met = docs["doc_id"].eqNullSafe(times["id"]) & (text_print == times["print"])
    repeated = docs.join(times, met).withColumn("time", F.explode(F.sequence(F.lit(1), F.col("times"))))
    return repeated.select(*COLUMNS)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document's ids, and whether they decode to its text again."""
    ranks = bpe.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    columns = ("doc_id", "lang", "source")
    whole = docs.select(*columns, "text", F.sha2(F.coalesce("text", F.lit("")), 256).alias("sha256"))
    encoded = bpe.encode(whole, ranks, public_tokenizers.PATTERN, *columns, "sha256")
    decoded = bpe.decode(encoded, ranks, *columns, "sha256", "ids")
    return decoded.select(*columns, F.expr("cast(octet_length(ids) div 4 as bigint)").alias("n_tokens"), "ids",
                          (F.sha2("decoded", 256) == F.col("sha256")).alias("intact"))


STAGES = [("toxicity", drop_toxic), ("quality rules", drop_poor), ("n-gram Jaccard join", one_of_each_group),
          ("mixing sources", mix_sources), ("byte-level BPE", encode)]

#: SQL can express neither the fitted model nor the tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; each reads what the one before it wrote."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for place, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if place < len(STAGES) - 1:
            docs = stored(docs, name.replace(" ", "-"))
    return docs
