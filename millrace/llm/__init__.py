"""Operators for preparing training corpora: deduplication, search, sharding,
privacy, mixing, tokens, decontamination and toxicity.

Nothing outside this package imports it.
"""
