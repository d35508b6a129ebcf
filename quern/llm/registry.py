"""The queries of this subpackage by name, and their SQL twins where SQL can express them."""

from __future__ import annotations

from quern.llm import bytebpe, fingerprints, licenses, media, neardup, packing, pii, secrets, sharding, toxicity, twins

_QUERIES = {
    "op1_toxicity": toxicity.query,
    "op10_pii_surrogates": pii.query,
    "op2_fingerprints": fingerprints.query,
    "op3_best_fit_packing": packing.query,
    "op4_secret_scan": secrets.query,
    "op5_shard_by_bytes": sharding.query,
    "op6_license_scan": licenses.query,
    "op7_byte_bpe": bytebpe.query,
    "op8_media_chunks": media.query,
    "op9_near_duplicates": neardup.query,
}

_ORACLE: dict[str, str] = {"op9_near_duplicates": neardup.ORACLE, **twins.ORACLE}


def queries():
    return _QUERIES | twins.QUERIES


def operators():
    """The ten queries alone."""
    return dict(_QUERIES)


def oracle_sql():
    return dict(_ORACLE)
