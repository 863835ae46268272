"""Operators for preparing training text at corpus scale.

Nothing outside this subpackage imports it.  Every operator takes DataFrames
and column names and returns DataFrames; `queries` binds them to the tables.
"""
