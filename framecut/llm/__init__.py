"""Operations of a training-data pipeline over a ``documents`` table.

Self-contained: nothing outside this folder imports it (only
``__spark_entry__.py``, behind a guard, and ``corpus_pipeline.py``).
"""
