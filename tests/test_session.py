from types import SimpleNamespace

import pytest

from titleweave import session


def test_small_tables_are_broadcast_and_large_ones_are_not(spark):
    facts = spark.range(50).selectExpr("id as k", "repeat('x', 100) as v")
    rows = spark.range(1000).selectExpr("id % 50 as k", "id")

    def plan(bound):
        joined = rows.join(session.broadcast_if_small(facts, bound), "k")
        return joined._jdf.queryExecution().executedPlan().toString()

    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # only hints count here
        assert "BroadcastHashJoin" in plan(50_000)
        assert "SortMergeJoin" in plan(1_000)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_checkpoints_go_to_the_configured_folder(spark):
    assert session.shared_folder(spark) == spark.conf.get("spark.checkpoint.dir").rstrip("/")
    frozen = session.freeze(spark.range(10))
    assert frozen.count() == 10
    assert spark.conf.get("spark.checkpoint.dir") in spark.sparkContext._jsc.sc().getCheckpointDir().get()


def test_a_cluster_without_a_shared_folder_is_refused():
    unset = SimpleNamespace(
        conf=SimpleNamespace(get=lambda key, default=None: default),
        sparkContext=SimpleNamespace(master="yarn"),
    )
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.shared_folder(unset)


def test_missing_tables_read_as_empty(spark, tmp_path):
    path = str(tmp_path / "ledger")
    assert session.read_or_empty(spark, path, "a int, b string").count() == 0
    spark.createDataFrame([(1, "x")], "a int, b string").write.parquet(path)
    assert session.read_or_empty(spark, path, "a int, b string").count() == 1
