"""Operators a training-data pipeline needs. Nothing else in the library imports this package.

``tidebook.llm.queries`` registers one query per operator over the whole of its table.
"""
