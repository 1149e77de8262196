"""Queries of the training-data operators and their DuckDB counterparts."""

from __future__ import annotations

from . import bpe, companions, fingerprints, language, licenses, mixing, neardup, pii, search, sharding, toxicity


def pipeline(spark, sf_dir):
    """All stages of the corpus pipeline."""
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def queries():
    return {
        "pipeline": pipeline,
        "op1_pii": pii.query,
        "op2_sharding": sharding.query,
        "op3_document_fingerprints": fingerprints.query,
        "op4_license_scans": licenses.query,
        "op5_exact_top_k_search": search.query,
        "op6_language_id": language.query,
        "op7_minhash_near_dedup": neardup.query,
        "op8_toxicity": toxicity.query,
        "op9_bpe_encoding_and_decoding": bpe.query,
        "op10_mixing": mixing.query,
        **companions.QUERIES,
    }


def oracle_sql():
    return {"op5_exact_top_k_search": search.ORACLE, "op7_minhash_near_dedup": neardup.ORACLE, **companions.ORACLES}
