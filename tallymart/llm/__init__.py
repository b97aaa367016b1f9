"""Operators for preparing language-model training data.

Nothing outside this package imports it.  All operators read the columns they
name and ignore the rest, so further columns may have any name and type.
"""
