"""Relational operators of record linkage, each a function of DataFrames."""
