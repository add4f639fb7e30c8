"""eddy: keyed-stream analytics on Spark.

Every operator is a function ``DataFrame -> DataFrame`` with explicit key,
event-time and tie-break columns. Batch forms are built from Spark SQL
expressions, windows, joins and aggregations; streaming forms use
Structured Streaming with checkpointed state.
"""

__version__ = "0.1.0"
