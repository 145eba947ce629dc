"""Spark-native analytics over application logs and trip records.

Every operator is a ``DataFrame -> DataFrame`` function built from
``pyspark.sql.functions``; sessions, paths and sinks live at the edges.
"""

__version__ = "0.1.0"
