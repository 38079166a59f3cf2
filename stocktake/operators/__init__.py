"""Operators: DataFrames in, DataFrame out. Wherever order decides, it is a column, never the order of rows."""
