"""Layer 2 (and 3 for the streaming twins): every registered query against
its DuckDB oracle on the small tables; rows-only queries must run."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(__file__)), "tools"))

import __spark_entry__ as E  # noqa: E402
from oracle_check import compare  # noqa: E402

SF = os.environ.get("EDDY_TEST_SF", "/root/testdata/sf0.001")
from eddy.plans import ORACLE_SQL, QUERIES  # noqa: E402

NAMES = list(QUERIES)  # the optional training-data queries have tests of their own


def test_registry_complete():
    assert set(QUERIES) <= set(E.queries()) and set(E.oracle_sql()) <= set(E.queries())
    qs, sql = QUERIES, ORACLE_SQL
    assert set(qs) - set(sql) == {"partition_tag", "ingest_stamp"}


@pytest.mark.parametrize("name", [n for n in NAMES if not n.startswith("stream_")])
def test_batch_query_matches_oracle(spark, name):
    res = compare(spark, SF, [name], verbose=True)
    assert res[name][0] in ("match", "rows-only"), res[name]


@pytest.mark.parametrize("name", [n for n in NAMES if n.startswith("stream_")])
def test_stream_twin_matches_oracle(spark, name):
    res = compare(spark, SF, [name], verbose=True)
    assert res[name][0] == "match", res[name]


def test_entry(spark):
    df = E.entry(spark)
    assert df.columns == ["user_id", "window_start", "window_end", "cnt"]
    assert df.count() > 0
