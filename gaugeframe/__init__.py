"""Declarative data-quality analytics as Spark jobs.

Every operator is a function from DataFrames to DataFrames; nothing runs until the
caller writes or collects the result.
"""
