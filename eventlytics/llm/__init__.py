"""Operators of a training-data pipeline over documents and web pages.

Thirteen operators, one module each; ``queries.py`` applies each to its whole
table. Nothing outside this subpackage imports it.
"""
