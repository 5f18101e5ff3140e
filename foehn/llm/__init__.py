"""Operators of a training-data pipeline over large text and vector corpora.

Nothing else in the library imports this subpackage.
"""
