"""Operators of a training-data pipeline over a table of documents.

Nothing outside this package imports it.  Every operator takes DataFrames and
column names, works on the whole table, and returns only the columns it
documents, so extra input columns never clash with its own.
"""
