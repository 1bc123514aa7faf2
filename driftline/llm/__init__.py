"""Operators of a training-data pipeline: deduplication, quality rules, HTML
extraction, mixing, packing, chat formatting, token counts, personal data, ranked
search, importance resampling, BPE.

Each module holds one operator with its general interface; ``queries.py``
registers the queries and their SQL. Nothing else in the library imports this
subpackage.
"""
