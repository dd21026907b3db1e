"""Operators of a training-data pipeline: text, vectors, archives and token sequences.

Nothing else in the package imports this subpackage.
"""
