"""Every registered query against its SQL twin, and the shape of the plans that matter."""

import re
from pathlib import Path

import pytest

import __spark_entry__ as registry
from oracle import compare, database

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(DATA).exists(), reason="driver tables are absent")


@pytest.fixture(scope="module")
def con():
    return database(DATA)


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_query_equals_its_sql(spark, con, name):
    assert compare(spark, con, registry.queries()[name], registry.oracle_sql()[name], DATA) == []


def test_entry_has_rows(spark):
    assert registry.entry(spark).count() > 0


def test_only_training_has_no_sql():
    own = {n for n in registry.queries() if not re.match(r"op\d+_|pipeline$", n)}
    assert own - set(registry.oracle_sql()) == {"gbt_train_score", "gbt_train_full"}


def executed_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


@pytest.mark.parametrize(
    "name, scans", [("station_state", 1), ("segments", 1), ("label_coverage", 1), ("dense_grid", 1), ("auc_exact", 0), ("split_rows", 0)]
)
def test_plans(spark, name, scans):
    """No cross or nested-loop join, no Python, and no input read twice, with broadcasts off as at scale."""
    limits = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold",)}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = executed_plan(registry.queries()[name](spark, DATA))
    finally:
        for k, v in limits.items():
            spark.conf.set(k, v)
    assert not re.search(r"CartesianProduct|BroadcastNestedLoopJoin|BatchEvalPython|ArrowEvalPython|BroadcastExchange", plan)
    if scans:
        assert plan.count("FileScan") == scans
