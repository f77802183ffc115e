"""Operators for preparing training data from tables of documents.

Nothing else in the library imports this package. The operators take any
DataFrame with an id and a text column; other columns are ignored or carried,
whatever their names.
"""
