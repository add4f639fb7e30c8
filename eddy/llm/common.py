"""Helpers shared by the training-data operators."""

from __future__ import annotations

import sys

import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import scratch_path

#: ASCII white space of the text contracts: blank, tab, LF, VT, FF, CR
WHITE = b"\x20\x09\x0a\x0b\x0c\x0d"
#: the same as a character class for SQL regular expressions
WORD_RE = "[^\\x20\\x09-\\x0D]+"

#: for DuckDB, which has no CRC: a common table ``crc`` with the 256 steps of CRC-32, from its rule
CRC32_SQL = """crc AS (SELECT list_transform(range(256), lambda b: list_reduce(list_prepend(b::BIGINT, range(8)),
    lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS tab)"""


def crc32_sql(text: str) -> str:
    """DuckDB: the CRC-32 of an ASCII string, in a query that also reads ``crc``."""
    codes = f"list_transform(range(1, length({text}) + 1), lambda i: ascii(substr({text}, i::INT, 1))::BIGINT)"
    return f"xor(list_reduce(list_prepend(4294967295::BIGINT, {codes}), lambda c, b: xor(tab[(xor(c, b) & 255) + 1], c >> 8)), 4294967295)"


def ship_by_value(module_name: str) -> None:
    """Let tasks run this module's functions without importing it there."""
    cloudpickle.register_pickle_by_value(sys.modules[module_name])


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet into the shared folder named by
    ``spark.checkpoint.dir`` and read it back: cuts lineage and survives the
    loss of executors."""
    return stored_at(df, name)[0]


def stored_at(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """:func:`stored`, and the folder: for :func:`emptied`, once it is spent."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def emptied(spark: SparkSession, path: str) -> None:
    """Free the space of a folder of :func:`stored_at` that nothing reads any more."""
    spark.range(0).write.mode("overwrite").parquet(path)


#: rows of an Arrow batch in operators that send whole texts to Python
BATCH_ROWS = 1000


def small_batches(spark: SparkSession) -> None:
    """Lower the session's rows of an Arrow batch to ``BATCH_ROWS``, if it allows
    more: a batch of whole texts is held several times, in the JVM and in Python."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(name, "10000")) <= BATCH_ROWS:
        spark.conf.set(name, str(BATCH_ROWS))


def give_back() -> None:
    """Return the memory that Arrow has freed but holds: Python workers live on after
    a task, and what each one holds is missing to the executor's later tasks."""
    pa.default_memory_pool().release_unused()


def text_column(name: str) -> Column:
    """The text, NULL as empty."""
    return F.coalesce(F.col(name), F.lit(""))


def batch_texts(batch: pa.RecordBatch, field: int | None) -> pa.Array:
    """The texts of an Arrow batch: its column ``text`` or, where the text is
    carried along anyway, that field of its struct ``extra`` (sent once)."""
    if field is None:
        return batch.column("text")
    return pc.struct_field(batch.column("extra"), [field])


def parts_for(spark: SparkSession, rows: int, rows_per_part: int) -> int:
    """Number of groups so that each holds about ``rows_per_part`` rows."""
    return max(1, -(-int(rows) // int(rows_per_part)))


def sums_before(df: DataFrame, order: list, values: list[str], name: str) -> DataFrame:
    """``df`` with ``before_<v>`` for each of ``values``: its sum over all rows that
    come earlier in ``order`` (columns that tell any two rows apart). Rows are
    range-partitioned; each range's sums go to all later ranges, so no task holds
    more than a range, and a row for each pair of ranges is all that is added."""
    ranges = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))
    dealt = df.repartitionByRange(ranges, *order).sortWithinPartitions(*order).withColumn("_m", F.monotonically_increasing_id())
    dealt = stored(dealt, name).withColumn("_range", F.shiftright("_m", 33))
    sums = dealt.groupBy("_range").agg(*[F.sum(v).alias(v) for v in values])
    last = sums.agg(F.max("_range")).first()[0] or 0
    later = sums.where(F.col("_range") < last).select(F.explode(F.sequence(F.col("_range") + 1, F.lit(last))).alias("_range"), *values)
    later = later.groupBy("_range").agg(*[F.sum(v).alias(f"_{v}") for v in values])
    inside = Window.partitionBy("_range").orderBy("_m").rowsBetween(Window.unboundedPreceding, -1)
    out = dealt.join(later, "_range", "left")
    zero = F.lit(0)
    return out.select("*", *[(F.coalesce(F.sum(v).over(inside), zero) + F.coalesce(f"_{v}", zero)).alias(f"before_{v}") for v in values]).drop("_m", "_range", *[f"_{v}" for v in values])


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``(node, root)`` for every node of the undirected ``edges``; ``root`` is
    the smallest node of its component.

    Alternating large-star and small-star rounds: every round is two joinless
    aggregations that replace edges by edges to smaller neighbours, so the
    edge count never grows and O(log^2 n) rounds suffice. A node with very
    many edges is met by partial aggregation and an ordinary join (which AQE
    can split); no neighbour list is built. Each round is written to the shared
    folder; the only thing the driver reads is two numbers a round.
    """
    def tidy(df):
        return (df.where(F.col("u") != F.col("v")).distinct())

    e = stored(tidy(edges.select(F.col(a).alias("u"), F.col(b).alias("v"))), "cc-edges")
    last = None
    while True:
        both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m"))
        low = low.select("u", F.least("u", "m").alias("m"))
        # large star: neighbours above u hang under the smallest of u's circle
        big = (both.where(F.col("v") > F.col("u")).join(low, "u")
               .select(F.col("v").alias("u"), F.col("m").alias("v")))
        big = tidy(big)
        # small star: neighbours at or below u, and u, under the smallest one
        down = big.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        least = down.groupBy("u").agg(F.min("v").alias("m"))
        small = (down.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .union(least.select("u", F.col("m").alias("v"))))
        e = stored(tidy(small), "cc-edges")
        n, s = e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if (n, s) == last:
            break
        last = (n, s)
    star = e.select(F.col("u").alias("node"), F.col("v").alias("root"))
    roots = e.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return star.union(roots)


ship_by_value(__name__)
