"""Stages that turn raw documents into token ids, each written and read again as Parquet."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.llm import bpe, catalog, decontaminate, jaccard, kneser_ney, pii
from plumbline.llm.common import materialise, table

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def _keyed(docs: DataFrame) -> tuple[DataFrame, str]:
    """Documents with a key of id and text together, and the name of its column.

    Rows of one id and different texts are judged apart; equal ones are judged alike.
    """
    key = "row_key"
    while key in docs.columns:
        key += "_"
    return docs.withColumn(key, F.xxhash64(F.col("doc_id").cast("bigint"), F.coalesce("text", F.lit("")))), key


def _without(docs: DataFrame, key: str, rejected: DataFrame) -> DataFrame:
    """Rows whose key is not rejected, with the columns of documents."""
    gone = rejected.select(F.col("doc_id").alias(key)).distinct()
    return docs.join(gone, key, "left_anti").drop(key)


def trusted_like(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents within their language's perplexity limit.

    Labels belong to all rows of their id. Null and empty texts have no word to judge by and
    go as the classifier says; equal rows share a verdict. No documents: none are left.
    """
    keyed, key = _keyed(docs)
    labels = table(spark, folder, "labels")
    keys = keyed.select(F.col("doc_id").cast("bigint").alias("doc_id"), key).distinct()
    labels = labels.join(keys, "doc_id").drop("doc_id").withColumnRenamed(key, "doc_id")
    judged = kneser_ney.quality_classifier(keyed, labels, key=key)
    return _without(keyed, key, judged.filter(~F.col("kept")))


def one_of_each(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """The document of the smallest id of each group of near-duplicates; of repeated rows one stays.

    Five-word shingles, similarity 0.8 or more. A null id comes last; equal ids go by key.
    Null and empty texts are near nothing, but are repeated rows if id and text are equal.
    """
    keyed, key = _keyed(docs)
    found = materialise(jaccard.similar_components(keyed, percent=80, size=5, key=key, rounds=2), "near-duplicates")
    ids = keyed.select(key, F.col("doc_id").cast("bigint").alias("id")).distinct()
    rank = F.struct(F.col("id").isNull(), F.col("id"), F.col("doc_id"))
    ranked = found.join(ids.withColumnRenamed(key, "doc_id"), "doc_id")
    first = ranked.groupBy("component_id").agg(F.min(rank)["doc_id"].alias("doc_id"))
    copies = materialise(found.select("doc_id").distinct().join(first, "doc_id", "left_anti").select("doc_id"), "copies")
    repeated = materialise(found.groupBy("doc_id").count().filter("count > 1").select("doc_id"), "repeated")
    kept = _without(keyed, key, copies.union(repeated))
    again = keyed.join(repeated.join(copies, "doc_id", "left_anti").withColumnRenamed("doc_id", key), key, "left_semi")
    return kept.unionByName(again.dropDuplicates([key]).drop(key))


def decontaminated(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents of which less than a twentieth of the words lie in benchmark windows.

    Texts without words stay; rows of one id are judged by their own text.
    """
    keyed, key = _keyed(docs)
    found = decontaminate.find_passages(keyed, table(spark, folder, "benchmark"), key=key)
    return _without(keyed, key, decontaminate.with_verdict(found).filter("contaminated"))


def private_data(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Personal data is replaced by its kind; n_chars follows the new text. Null texts stay null."""
    clean = docs.withColumn("text", pii.redacted(F.col("text")))
    return clean.withColumn("n_chars", F.length("text").cast("bigint"))


def token_ids(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Rows (doc_id, n_tokens, ids_sha256, decoded_sha256) of every text left; null has no tokens."""
    return bpe.bpe_round_trip(docs, catalog.RANKS, catalog.PATTERN)


STAGES: list[tuple[str, Stage]] = [
    ("quality", trusted_like),
    ("near-duplicates", one_of_each),
    ("decontamination", decontaminated),
    ("pii", private_data),
    ("bpe", token_ids),
]

#: SQL cannot express the classifier; tests hold the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, folder: str) -> DataFrame:
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, folder), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, folder)
