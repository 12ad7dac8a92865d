"""The operators as queries with production parameters, and SQL where SQL can say the same."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from plumbline.llm import bpe, chat, decontaminate, hard_negatives, jaccard, kneser_ney, lattice, manifest, merkle, pii, suffix_dedup, url_filter
from plumbline.llm import quality_rules as rules
from plumbline.llm.common import materialise, table

QUERIES, ORACLES = {}, {}

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
PATTERN = public_tokenizers.PATTERN
PIECES = public_tokenizers.path("piece_bpe_32k.model")


def query(name: str, sql: str | None = None):
    def register(function):
        QUERIES[name] = function
        if sql is not None:
            ORACLES[name] = sql
        return function

    return register


@query("op2_pii_spans")
def pii_spans(spark: SparkSession, folder: str) -> DataFrame:
    return pii.pii_report(pii.find_pii(table(spark, folder, "documents")))


@query("op7_bpe_round_trip")
def bpe_round_trip(spark: SparkSession, folder: str) -> DataFrame:
    return bpe.bpe_round_trip(table(spark, folder, "documents"), RANKS, PATTERN)


@query("op9_chat_format", chat.SQL)
def chat_format(spark: SparkSession, folder: str) -> DataFrame:
    events = chat.events_of_turns(chat.with_forged(spark, folder))
    return chat.format_report(chat.render(chat.fold_events(events)))


@query("op10_quality_rules")
def quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    return rules.quality_rules(table(spark, folder, "documents"))


@query("op4_decontaminate", decontaminate.SQL)
def decontaminate_documents(spark: SparkSession, folder: str) -> DataFrame:
    found = decontaminate.find_passages(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    return decontaminate.contamination_report(found)


@query("op6_jaccard_join")
def jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard.similar_components(table(spark, folder, "documents"), percent=90, size=3)


@query("op1_quality_classifier")
def quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    return kneser_ney.quality_classifier(table(spark, folder, "documents"), table(spark, folder, "labels"))


@query("op5_lattice_lm")
def lattice_lm(spark: SparkSession, folder: str) -> DataFrame:
    return lattice.lattice_scores(table(spark, folder, "documents"), PIECES)


@query("op8_suffix_dedup")
def suffix_dedup_documents(spark: SparkSession, folder: str) -> DataFrame:
    return suffix_dedup.repeats_report(suffix_dedup.find_repeats(table(spark, folder, "documents")))


@query("op3_merkle_audit", merkle.SQL)
def merkle_audit(spark: SparkSession, folder: str) -> DataFrame:
    records = materialise(merkle.archive_records(spark, folder), "archive")
    return merkle.fixity_audit(records, merkle.damaged(records))


@query("op13_url_filter", url_filter.SQL)
def url_filter_pages(spark: SparkSession, folder: str) -> DataFrame:
    return url_filter.url_verdicts(table(spark, folder, "pages"))


@query("op12_merkle_manifest", manifest.SQL)
def merkle_manifest(spark: SparkSession, folder: str) -> DataFrame:
    return manifest.documents_manifest(spark, folder)


@query("op11_hard_negatives", hard_negatives.SQL)
def mined_negatives(spark: SparkSession, folder: str) -> DataFrame:
    return hard_negatives.mined(spark, folder)
