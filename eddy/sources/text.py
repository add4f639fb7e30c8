"""Text-line sources and sinks.

The reference reads ``id,timestamp,temperature`` lines from text files and
``key,value`` lines from sockets. Here lines are either read with
``spark.read.text`` (``scan_text``) or rendered from a table by Spark
(``render_*``) and then parsed with built-in expressions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import epoch_us, split_like_java


def render_reading_lines(events: DataFrame, key: str = "user_id",
                         ts: str = "ts", value: str = "value",
                         extra: list[str] | None = None) -> DataFrame:
    """``id,epoch_seconds,temperature`` lines from an event table. The value
    is printed with two decimals so every engine prints it alike."""
    sec = F.floor(epoch_us(ts) / F.lit(1_000_000)).cast("bigint")
    line = F.concat_ws(",", F.col(key).cast("string"), sec.cast("string"),
                       F.col(value).cast("decimal(10,2)").cast("string"))
    return events.select(*(extra or []), line.alias("value"))


def render_pair_lines(events: DataFrame, key: str = "user_id",
                      value: str = "event_type",
                      extra: list[str] | None = None) -> DataFrame:
    """``key,value`` lines from an event table."""
    line = F.concat_ws(",", F.col(key).cast("string"), F.col(value).cast("string"))
    return events.select(*(extra or []), line.alias("value"))


def scan_text(spark: SparkSession, path: str) -> DataFrame:
    """Bounded text-file scan: one row per line, column ``value``."""
    return spark.read.text(path)


def write_lines(lines: DataFrame, path: str, col: str = "value") -> str:
    """Text sink: one line per row (the file form of ``print``)."""
    lines.select(F.col(col).alias("value")).write.mode("error").text(path)
    return path


def parse_readings(lines: DataFrame, col: str = "value", sep: str = ",",
                   mode: str = "strict", keep: list[str] | None = None) -> DataFrame:
    """Parse ``id,timestamp,temperature`` lines to typed readings (S3).

    ``mode='strict'`` fails the job on a malformed line (as the reference
    does); ``mode='permissive'`` turns bad fields into NULL and adds a
    ``_bad`` flag so callers can route rejects.
    """
    parts = split_like_java(F.col(col), sep)
    keep = keep or []
    if mode == "strict":
        n = F.size(parts)
        checked = F.when(n >= 3, parts).otherwise(
            F.raise_error(F.concat(F.lit("malformed reading: "), F.col(col))))
        return lines.select(
            *keep,
            F.element_at(checked, 1).alias("id"),
            F.element_at(checked, 2).cast("bigint").alias("timestamp"),
            F.element_at(checked, 3).cast("double").alias("temperature"))
    ts = F.try_element_at(parts, F.lit(2))
    tp = F.try_element_at(parts, F.lit(3))
    out = lines.select(
        *keep,
        F.try_element_at(parts, F.lit(1)).alias("id"),
        ts.try_cast("bigint").alias("timestamp"),
        tp.try_cast("double").alias("temperature"))
    return out.withColumn(
        "_bad", F.col("id").isNull() | F.col("timestamp").isNull()
        | F.col("temperature").isNull())


def parse_pairs(lines: DataFrame, col: str = "value", sep: str = ",",
                keep: list[str] | None = None) -> DataFrame:
    """Parse ``key,value`` lines to ``(k, v)``."""
    parts = split_like_java(F.col(col), sep)
    checked = F.when(F.size(parts) >= 2, parts).otherwise(
        F.raise_error(F.concat(F.lit("malformed pair: "), F.col(col))))
    return lines.select(*(keep or []),
                        F.element_at(checked, 1).alias("k"),
                        F.element_at(checked, 2).alias("v"))


def labelled(df: DataFrame, label: str, col: str = "stream") -> DataFrame:
    """Labelled sink (``print(label)``): tag every row with its stream name."""
    return df.select(F.lit(label).alias(col), "*")
