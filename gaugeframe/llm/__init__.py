"""Operators for preparing training data for language models.

Nothing outside this subpackage imports it. Every operator takes and returns DataFrames; the
registered queries and their SQL are in `queries` and `oracle`.
"""
