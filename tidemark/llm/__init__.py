"""Operators of a training-data pipeline: cleaning, deduplication, mixing, scoring, tokenizing.

Nothing else in the library imports this subpackage. Each operator takes a documents frame
(``doc_id``, ``text``, any other columns) and picks the columns that it needs by name, so extra
columns of the caller can have any name.
"""
