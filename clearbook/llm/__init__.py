"""Operators for large text corpora: scoring, deduplication, decontamination, mixing, search, extraction, formatting.

One module per operator, each with a DataFrame interface of its own; ``registry`` holds the named queries over the
sample tables and the SQL for those that SQL can express. Nothing outside this folder imports it.
"""
