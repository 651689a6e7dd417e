"""Operators for building training corpora at scale.

Each module holds one operator: a function from DataFrames to a DataFrame.
``queries`` registers one query per operator, ``oracles`` the DuckDB
statements of those that SQL can express.  Nothing outside this subpackage
(and ``corpus_pipeline.py``) imports it.
"""
