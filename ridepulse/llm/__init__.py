"""Operators for preparing training text: one module per operator, queries in ``queries.py``.

Nothing outside this package imports it. ``corpus_pipeline.py`` at the repository root chains five of them.
"""
