"""Operators for preparing training corpora.

Nothing else in the library imports this package; its queries are listed in
:mod:`histlake.llm.queries` and the five-stage run in ``corpus_pipeline.py``.
"""
