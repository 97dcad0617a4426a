"""Operators for training corpora, each a function from DataFrames to DataFrames."""
