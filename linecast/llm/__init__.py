"""Operators for preparing training data at scale.

Every operator takes DataFrames and returns DataFrames. Nothing else in the
library imports this subpackage.
"""
