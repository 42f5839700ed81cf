"""Training-data operators: ten corpus components on Spark DataFrames.

Nothing outside this subpackage imports it.
"""
