"""Operators of a training-data pipeline over text tables.

Nothing else in the library imports this subpackage.  Every operator takes and returns Spark
DataFrames; ``queries`` maps the registered ``opN_`` names to thin queries over the test tables.
"""
