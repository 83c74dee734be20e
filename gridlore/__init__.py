"""Spark DataFrame functions for proximity, review and review-text analysis.

Every function takes and returns DataFrames. Column expressions live in
``functions``, readers and writers in ``sources``, joins, aggregates and
trained models in ``operators``, and whole reports in ``plans``.
"""
