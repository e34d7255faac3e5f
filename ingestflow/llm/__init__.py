"""Corpus operators for training-data pipelines.

One module per operator, each a set of functions from DataFrames to
DataFrames; ``queries`` holds the registered ``opN_*`` queries and their SQL.
Nothing outside this package imports it (only ``__spark_entry__`` does, when
the package is there).
"""
