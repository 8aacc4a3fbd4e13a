"""Operators of a training-data pipeline (deduplication, language, tokens, …).

Nothing else in the library imports this subpackage.  Every operator takes and
returns DataFrames; :mod:`tallyfold.llm.queries` registers one query for each.
"""
