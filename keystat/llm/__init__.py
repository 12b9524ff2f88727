"""Operators of a training-data pipeline, and their registered queries.

Each module holds one operator with its own interface (texts, spans, edges,
tokens); :mod:`keystat.llm.queries` derives the registered queries from them.
"""
