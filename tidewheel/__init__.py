"""Generic PySpark operators for tabular and streaming analytics.

Every operator takes DataFrames and returns DataFrames; see the README for the
map from capability to module.
"""

__version__ = "0.1.0"
