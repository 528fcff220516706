"""Operators of a training-data pipeline (dedup, quality, language, tokens, packing, search, shards).

Nothing outside this folder imports it.
"""
