"""Operators of a training-data pipeline (see the module docstrings for each contract).

Nothing outside this subpackage, ``corpus_pipeline.py`` and the guard in
``__spark_entry__.py`` imports it.
"""
