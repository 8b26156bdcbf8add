"""The queries of this package and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tripmart.llm import interaction, jaccard, language, mixing, packing, quotes, ranking, repair, repetition, secrets, spotsigs, subspaces, urls


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_secret_scans": secrets.query,
        "op2_packing": packing.query,
        "op3_mixing": mixing.query,
        "op4_language_id": language.query,
        "op5_ngram_jaccard_join": jaccard.query,
        "op6_quality_rules": repetition.query,
        "op7_quality_classifier": ranking.query,
        "op8_document_fingerprints": spotsigs.query,
        "op9_url_filters": urls.query,
        "op10_quotation_linking": quotes.query,
        "op11_embedding_dedup": subspaces.query,
        "op12_filter_audit": interaction.query,
        "op13_conversation_repair": repair.query,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op1_secret_scans": secrets.SQL,
        "op3_mixing": mixing.SQL,
        "op8_document_fingerprints": spotsigs.SQL,
        "op9_url_filters": urls.SQL,
        "op10_quotation_linking": quotes.SQL,
        "op11_embedding_dedup": subspaces.SQL,
        "op12_filter_audit": interaction.SQL,
    }
