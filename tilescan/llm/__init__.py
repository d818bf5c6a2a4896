"""Training-data operators: near-duplicates, extraction, tokens, mixing, scoring, fingerprints.

Nothing outside this package imports it.  ``queries`` has the entry points.
"""
