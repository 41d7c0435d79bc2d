"""Operators for training-data pipelines over a corpus of documents.

Each module holds one operator with its general interface; ``queries`` applies
them to the supplied tables. Nothing outside this folder imports it.
"""
