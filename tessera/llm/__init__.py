"""Training-data operators: scans, near-duplicate search, tokenising, scoring and masking of text corpora.

Nothing outside this subpackage imports it.  Each operator is a function over
DataFrames with its own options; ``queries`` applies them to whole tables.
"""
