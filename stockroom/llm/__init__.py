"""Training-data operators. Nothing outside this folder imports it, but for the
guarded registration in ``__spark_entry__.py`` and ``corpus_pipeline.py``."""
