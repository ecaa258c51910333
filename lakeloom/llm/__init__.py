"""Operators for large training-text corpora.

Nothing else in the library imports this subpackage. Every operator reads
DataFrames, runs on the executors, writes intermediate tables only into the
shared folder the cluster names in ``spark.checkpoint.dir`` and returns a
DataFrame. ``queries.py`` registers one thin query per operator.
"""
