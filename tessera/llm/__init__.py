"""Operators of a training-data pipeline over a document corpus.

Each module holds one operator with a general DataFrame interface;
``queries`` applies them to the test tables and derives the digest columns.
"""
