"""Operators of a large-scale training-data pipeline.

Each module holds one operator with a general interface (DataFrames in,
DataFrames out); :mod:`mercato.llm.queries` applies them to whole tables.
"""
