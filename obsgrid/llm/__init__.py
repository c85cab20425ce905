"""Operators for preparing large text corpora, each on Spark DataFrames.

One module per operator; ``catalog`` registers their queries. Nothing outside
this subpackage imports it, apart from the guarded entry point.
"""
