"""Operators for preparing training text.

Nothing else in the package imports this subpackage; it can be removed whole.
Every operator takes and returns DataFrames, reads only the columns it names
(extra columns, whatever they are called, are ignored) and runs over all rows.
"""
