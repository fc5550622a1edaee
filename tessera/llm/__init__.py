"""Operators for building large text-training corpora with Spark.

Nothing outside this subpackage imports it.
"""
