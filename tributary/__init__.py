"""Change-data-capture routing and indexing as Spark DataFrame functions.

Every operator is ``f(df, ...) -> df`` built from Spark SQL expressions, so the
same code runs in batch and in Structured Streaming.
"""

__version__ = "0.1.0"
