"""Operators of a training-data pipeline: duplicates, contamination, language, quality, secrets, mixing.

Nothing else in the library imports this subpackage. ``suite`` registers one query per operator.
"""
