"""Operators for building language-model training corpora.

Each module holds one operator with a general interface and the thin
``opN_*`` query that applies it to a whole table.  Nothing outside this
subpackage imports it.
"""
