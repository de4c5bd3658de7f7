"""lodgeflow: a Spark-native hotel-booking lakehouse engine.

Operators are ``DataFrame -> DataFrame`` functions with column names as
parameters; they run on batch and streaming DataFrames alike.
"""

__version__ = "0.1.0"
