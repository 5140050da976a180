"""Operators for preparing language-model training data, each in its own module.

Nothing outside this folder (and ``corpus_pipeline.py`` and the guarded import in
``__spark_entry__.py``) imports it.
"""
