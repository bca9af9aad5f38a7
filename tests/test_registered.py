"""Every registered query: same rows as its SQL, and a plan without Python, loops or cross products."""

import os
import re

import pytest

from compare import connect, rows_of_spark, rows_of_sql

import __spark_entry__ as entry
from verification.queries import REGISTRY

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
# Operators for training text have tests of their own, beside them.
QUERIES = {name: q for name, q in entry.queries().items() if name in REGISTRY}
SQL = {name: sql for name, sql in entry.oracle_sql().items() if name in REGISTRY}
FORBIDDEN = re.compile(r"BatchEvalPython|ArrowEvalPython|MapInPandas|CartesianProduct|BroadcastNestedLoopJoin")

# Rules and repairs that are plain Python go through one exchange of Arrow batches.
PYTHON = {"validate_python_rule", "repair_python"}

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


@pytest.fixture(scope="module")
def connection():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, connection, name):
    df = QUERIES[name](spark, SF_DIR)
    plan = df._jdf.queryExecution().executedPlan().toString()
    if name in PYTHON:
        # One for each branch of a union.
        assert plan.count("ArrowEvalPython") == plan.count("FileScan")
        plan = plan.replace("ArrowEvalPython", "")
    assert not FORBIDDEN.search(plan)
    columns, got = rows_of_spark(df)
    assert sum(got.values()) > 0
    if name in SQL:
        expected_columns, expected = rows_of_sql(connection, SQL[name])
        assert columns == expected_columns
        assert got == expected


def test_every_text_belongs_to_a_query():
    assert set(SQL) <= set(QUERIES)


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["ma_don_hang", "ma_khach_hang", "ngay_dat", "tong_tien", "trang_thai"] and df.count() > 0


def test_skewed_star_in_any_partitioning(spark):
    """Results do not depend on how the input is cut up or on the join strategy."""
    from verification import queries as Q

    def keys():
        return rows_of_spark(Q.clean_orders(spark, SF_DIR))

    expected = keys()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.shuffle.partitions", "13")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        assert keys() == expected
    finally:
        for key, value in (("spark.sql.shuffle.partitions", "4"),):
            spark.conf.set(key, value)
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
