"""Operators of a large-scale training-data pipeline, on Spark.

Nothing else in the library imports this subpackage. ``queries`` registers one
query per operator; ``corpus_pipeline.py`` chains five of them.
"""
