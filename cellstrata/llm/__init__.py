"""Operators that prepare text corpora for training.

Nothing outside this subpackage imports it; `queries` holds the registered
queries of the operators and their SQL.
"""
