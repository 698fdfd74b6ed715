"""Operators for large text corpora: scoring, search, cleaning, joins, tokens, mixing.

Nothing outside this package imports it. Every operator takes DataFrames and names of
columns and gives DataFrames; ``queries`` registers one query for each operator.
"""
