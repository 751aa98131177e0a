"""Operators for preparing text and vectors as training data.

Nothing else in the library imports this package.  Every operator takes and
returns DataFrames and names its columns by parameters; ``queries.py`` applies
them to whole tables.
"""
