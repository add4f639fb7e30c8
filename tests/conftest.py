import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark():
    from eddy.session import local_session
    s = local_session("*", shuffle_partitions=8, app="eddy-tests")
    yield s
    s.stop()


# The reference's only data file, seven lines repeated four
# times, then a five-line tail (id, epoch seconds, temperature).
SENSOR_BLOCK = [
    ("sensor_1", 1547718199, 35.8),
    ("sensor_6", 1547718201, 15.4),
    ("sensor_7", 1547718202, 6.7),
    ("sensor_10", 1547718205, 38.1),
    ("sensor_1", 1547718207, 36.3),
    ("sensor_1", 1547718209, 32.8),
    ("sensor_1", 1547718212, 37.1),
]
SENSOR_TAIL = [
    ("sensor_7", 1547718202, 26.7),
    ("sensor_10", 1547718205, 38.1),
    ("sensor_1", 1547718207, 56.3),
    ("sensor_1", 1547718209, 32.8),
    ("sensor_1", 1547718212, 37.1),
]
SENSOR_ROWS = SENSOR_BLOCK * 4 + SENSOR_TAIL


def sensor_lines():
    return [f"{i},{t},{v}" for i, t, v in SENSOR_ROWS]


@pytest.fixture(scope="session")
def sensor_text(spark):
    """The 33 lines as a one-column text DataFrame with arrival order ``seq``."""
    return spark.createDataFrame([(i, l) for i, l in enumerate(sensor_lines())],
                                 "seq bigint, value string")


@pytest.fixture(scope="session")
def readings(spark, sensor_text):
    """Parsed readings with an event-time column ``ts`` (timestamp_ntz)."""
    from eddy.functions.columns import ntz_from_us
    from eddy.sources import parse_readings
    from pyspark.sql import functions as F
    r = parse_readings(sensor_text, keep=["seq"])
    return r.withColumn("ts", ntz_from_us(F.col("timestamp") * 1_000_000)).cache()
