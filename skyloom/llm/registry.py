"""Queries of the training-data operators and their oracle SQL."""

from __future__ import annotations

import corpus_pipeline
from skyloom.llm import bpe, centroids, importance, langid, licenses, media, packing, quality, sharding, simhash, suffixes, toxicity, warc


def queries() -> dict:
    return {
        "pipeline": corpus_pipeline.run,
        "op1_packing": packing.op1_packing,
        "op2_license_scan": licenses.op2_license_scan,
        "op3_quality_rules": quality.op3_quality_rules,
        "op4_sharding": sharding.op4_sharding,
        "op5_toxicity": toxicity.op5_toxicity,
        "op6_media_columns": media.op6_media_columns,
        "op7_simhash": simhash.op7_simhash,
        "op8_bpe": bpe.op8_bpe,
        "op9_warc_derivatives": warc.op9_warc_derivatives,
        "op10_language_id": langid.op10_language_id,
        "op11_suffixes": suffixes.op11_suffixes,
        "op12_centroids": centroids.op12_centroids,
        "op13_importance": importance.op13_importance,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op9_warc_derivatives": warc.ORACLE_SQL,
        "op11_suffixes": suffixes.ORACLE_SQL,
        "op12_centroids": centroids.ORACLE_SQL,
        "op13_importance": importance.ORACLE_SQL,
    }
