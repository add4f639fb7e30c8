"""Table sources. Schemas are explicit (never inferred) so that a scan
reads only the columns a query needs (``ReadSchema`` in ``explain``)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

EVENTS_SCHEMA = T.StructType([
    T.StructField("event_id", T.LongType()),
    T.StructField("ts", T.TimestampNTZType()),
    T.StructField("user_id", T.LongType()),
    T.StructField("event_type", T.StringType()),
    T.StructField("value", T.DoubleType()),
    T.StructField("props", T.StringType()),
])

# The record type of the reference: id, epoch-second timestamp, temperature.
READING_SCHEMA = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("timestamp", T.LongType()),
    T.StructField("temperature", T.DoubleType()),
])

# Two-field text record used by the two-stream operators.
PAIR_SCHEMA = T.StructType([
    T.StructField("k", T.StringType()),
    T.StructField("v", T.StringType()),
])

SCHEMAS = {"events": EVENTS_SCHEMA}


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    reader = spark.read
    if name in SCHEMAS:
        reader = reader.schema(SCHEMAS[name])
    return reader.parquet(table_path(sf_dir, name))


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The keyed event table: (event_id, ts, user_id, event_type, value, props)."""
    return read_table(spark, sf_dir, "events")
