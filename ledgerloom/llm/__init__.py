"""Operators of a training-data pipeline over the ``documents`` tables.

Nothing outside this package imports it.  ``registry`` lists its queries and
SQL; ``corpus_pipeline.py`` at the repository top chains five of the operators.
"""
