"""Training-data operators: mixing, joins, tokenisation, deduplication, scoring.

Nothing outside this subpackage imports it.
"""
