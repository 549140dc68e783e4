"""Experiment-record lakehouse operators for Spark.

Nested JSON records land in files, are flattened to a declared schema, typed,
reduced to their newest version, merged into keyed tables and summarised. Every
step is a function from DataFrames to DataFrames; Catalyst plans the rest.
"""

__version__ = "0.1.0"
