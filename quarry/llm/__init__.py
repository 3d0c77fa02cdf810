"""Operators of a training-data pipeline. Nothing outside this subpackage,
``corpus_pipeline.py`` and the driver entry imports it."""
