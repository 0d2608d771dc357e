"""ordermill: e-commerce order-line analytics on Spark DataFrames.

Every operator is a ``DataFrame -> DataFrame`` function built from Spark's
built-in expressions, so Catalyst can prune, push down and plan the work.
"""

__version__ = "0.1.0"
