"""Operators of a large-scale training-data pipeline.

Nothing else in the library imports this subpackage, so it can be removed as
a whole.  Every operator takes and returns DataFrames; ``queries`` binds them
to the tables of a test directory.
"""
