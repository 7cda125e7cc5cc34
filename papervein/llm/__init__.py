"""Operators for preparing large training corpora.

Each module holds one operator with its own general interface; ``queries`` applies them to
the given tables and derives the digest columns, ``oracle`` has the SQL counterparts.
Nothing outside this folder and the pipeline imports it.

Common rules: a null text counts as empty, texts are always read whole, an empty table gives
an empty result of the same schema, and columns an operator does not need are ignored (or
passed through unchanged where it filters rows), whatever their names.
"""
