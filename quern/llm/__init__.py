"""Training-data operators: scoring, fingerprints, packing, scans, sharding, tokenizing, media, near-dedup and PII.

Nothing else in the library imports this subpackage; it can be removed whole.
"""
