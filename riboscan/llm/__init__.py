"""Operators for preparing large text corpora as training data.

Nothing outside this subpackage imports it. ``riboscan.llm.registry`` lists
its queries and their SQL.
"""
