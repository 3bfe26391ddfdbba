"""strata: layered (bronze / silver / gold) warehouse operators on Spark DataFrames.

Every operator is a function from DataFrames to a DataFrame, built from Spark's own
expressions, joins, aggregates and windows, and takes its column names as parameters.
"""

__version__ = "0.1.0"
