"""Queries of the training-data operators, for the driver's entry module."""

from __future__ import annotations

from . import bpe, decontaminate, erasure, hmm, jaccard, language, pii, pivots, quality, runs, secrets, sharding, url_filter


def queries() -> dict:
    return {
        "op1_secret_scans": secrets.op1_secret_scans,
        "op2_lm_scoring": hmm.op2_lm_scoring,
        "op3_decontamination": decontaminate.op3_decontamination,
        "op4_jaccard_join": jaccard.op4_jaccard_join,
        "op5_bpe": bpe.op5_bpe,
        "op6_language_id": language.op6_language_id,
        "op7_quality_rules": quality.op7_quality_rules,
        "op8_pii": pii.op8_pii,
        "op9_url_filters": url_filter.op9_url_filters,
        "op10_sharding": sharding.op10_sharding,
        "op11_cascading_erasure": erasure.op11_cascading_erasure,
        "op12_near_vectors": pivots.op12_near_vectors,
        "op13_periodic_runs": runs.op13_periodic_runs,
    }


def oracle_sql() -> dict[str, str]:
    """Where SQL can express the result; the others are held against brute force in the tests."""
    return {
        "op1_secret_scans": secrets.ORACLE,
        "op3_decontamination": decontaminate.ORACLE,
        "op4_jaccard_join": jaccard.ORACLE,
        "op7_quality_rules": quality.ORACLE,
        "op9_url_filters": url_filter.oracle(),
        "op12_near_vectors": pivots.ORACLE,
        "op13_periodic_runs": runs.ORACLE,
    }
