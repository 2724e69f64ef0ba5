import pytest
from pyspark.sql import functions as F

from snapgrid.operators import rows


def as_set(df):
    return {tuple(r) for r in df.collect()}


def test_latest_and_first_per_key(spark):
    df = spark.createDataFrame([(1, 5, "a"), (1, 7, "b"), (1, 7, "c"), (2, None, "d"), (2, 1, "e"), (3, None, "f")], "k int, t int, v string")
    assert as_set(rows.latest_per_key(df, ["k"], ["t"])) == {(1, 7, "c"), (2, 1, "e"), (3, None, "f")}
    assert as_set(rows.first_per_key(df, ["k"], ["t"])) == {(1, 5, "a"), (2, 1, "e"), (3, None, "f")}


def test_duplicates(spark):
    df = spark.createDataFrame([(1, None), (1, None), (2, "x"), (1, None)], "k int, v string")
    assert as_set(rows.duplicate_rows(df)) == {(1, None, 2)}
    assert tuple(rows.duplicate_report(df, "k").first()) == (4, 2, 2)
    assert tuple(rows.duplicate_report(df.limit(0), "k").first()) == (0, 0, 0)


def test_modes(spark):
    data = [(1, 2, "x"), (1, 1, None), (1, 2, None), (1, 1, "y"), (1, 10, "y"), (2, None, None), (3, 10, "b"), (3, 9, "a")]
    df = spark.createDataFrame(data, "k int, a int, b string")
    assert as_set(rows.modes(df, "k", ["a", "b"])) == {(1, 1, "y"), (2, None, None), (3, 9, "a")}


def test_modes_keep_types(spark):
    df = spark.sql("select 1 as k, 0.1D as d, timestamp'2025-01-01' as t, true as f")
    assert rows.modes(df, "k", ["d", "t", "f"]).dtypes == df.dtypes
    assert as_set(rows.modes(df, "k", ["d", "t", "f"])) == as_set(df)


def test_contract_on_columns(spark):
    df = spark.range(1)
    assert rows.require_columns(df, ["id"]) is df
    with pytest.raises(KeyError, match="'a', 'b'"):
        rows.require_columns(df, ["b", "a", "id"])


def test_replace_and_prefix(spark):
    df = spark.createDataFrame([(1, 2, 3)], "port_a int, b int, c int")
    assert rows.prefix_columns(df, "port_", keep_prefixed=True).columns == ["port_a", "port_b", "port_c"]
    assert rows.prefix_columns(df, "x_").columns == ["x_port_a", "x_b", "x_c"]
    assert rows.replace_column(df, "b", "c").collect() == [(1, 3)]
    with pytest.raises(KeyError):
        rows.replace_column(df, "b", "missing")


@pytest.mark.parametrize("how", ["left", "inner", "left_semi", "left_anti"])
def test_lookup_join_of_copies_nulls_and_maps(spark, how):
    """A third of the rows are copies of one row, some have no key, and one column is a map."""
    key = F.when(F.col("id") % 3 == 0, 0).when(F.col("id") % 7 != 0, F.col("id") % 50)
    value = F.when(F.col("id") % 3 != 0, F.col("id"))
    left = spark.range(1000).select(value.alias("id"), key.alias("k"), F.create_map(F.lit("a"), F.lit(1)).alias("m"))
    right = spark.range(40).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    got = rows.lookup_join(left, right, ["k"], how).collect()
    known = [(None if i % 3 == 0 else i, 0 if i % 3 == 0 else i % 50 if i % 7 else None) for i in range(1000)]
    held = [(i, k) for i, k in known if k is not None and k < 40]
    want = {"left": known, "inner": held, "left_semi": held, "left_anti": [x for x in known if x not in held]}[how]
    assert sorted(((r["id"], r["k"]) for r in got), key=str) == sorted(want, key=str)
    with pytest.raises(ValueError):
        rows.lookup_join(left, right, ["k"], "full")


def test_adaptive_execution_splits_the_copies_of_a_hot_key(spark):
    """No task of the join reads more than a fraction of the hot key's rows."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "8k",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    }
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        left = spark.range(0, 120_000, 1, 16).select(F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id")).alias("k"))
        right = spark.range(-1, 120_000).select(F.col("id").alias("k"), F.lit(1).alias("v"))
        joined = rows.lookup_join(left, right, ["k"], "inner")
        joined.collect()
        plan = joined._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert "skew=true" in plan


def test_dotted_names(spark):
    df = spark.createDataFrame([(1, 5, "a"), (1, 7, "b"), (1, 7, "b")], "`k.x` int, `t.y` int, `v w` string")
    assert as_set(rows.latest_per_key(df, ["k.x"], ["t.y"])) == {(1, 7, "b")}
    assert as_set(rows.duplicate_rows(df)) == {(1, 7, "b", 1)}
    assert tuple(rows.duplicate_report(df, "k.x").first()) == (3, 1, 1)
