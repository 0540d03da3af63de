"""Operators for preparing training data: near-duplicate joins, licence scans, language
identification, vector search, tokenisation, personal data, packing and chat formatting.

Nothing outside this subpackage imports it.
"""
