"""Operators for preparing training corpora, one module per operator.

Nothing outside this folder imports it.  ``queries.py`` registers one query
per operator; ``corpus_pipeline.py`` at the repository top chains five of
them.
"""
