"""Operators of a large-scale training-data pipeline.

Each module holds one operator with a general interface (DataFrame in,
DataFrame out); ``queries`` registers a thin query per operator.  Nothing
else in the library imports this subpackage.
"""
