"""The registered queries of the training-data operators, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from lodestone.llm import clustering, decontam, html, langid, media, packing, repair, resampling, secrets, setjoin, suffixes, tokens, urlrules


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_media_columns": media.op1_media_columns,
        "op2_token_counts": tokens.op2_token_counts,
        "op3_best_fit_packing": packing.op3_best_fit_packing,
        "op4_secret_scan": secrets.op4_secret_scan,
        "op5_html_extraction": html.op5_html_extraction,
        "op6_decontamination": decontam.op6_decontamination,
        "op7_language_id": langid.op7_language_id,
        "op8_url_filter": urlrules.op8_url_filter,
        "op9_jaccard_join": setjoin.op9_jaccard_join,
        "op10_token_id_files": repair.op10_token_id_files,
        "op11_suffix_dedup": suffixes.op11_suffix_dedup,
        "op12_importance_resampling": resampling.op12_importance_resampling,
        "op13_centroid_clusters": clustering.op13_centroid_clusters,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op8_url_filter": urlrules.ORACLE,
        "op9_jaccard_join": setjoin.ORACLE,
        "op11_suffix_dedup": suffixes.ORACLE,
        "op12_importance_resampling": resampling.ORACLE,
        "op13_centroid_clusters": clustering.ORACLE,
    }
