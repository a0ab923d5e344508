"""Plan checks over every registered query: no cartesian or nested-loop joins and
no Python evaluation; scans read only the columns a query needs."""

import pytest

import __spark_entry__ as entry
from fleetlake.plans import registry
from tools.plan_audit import plan_text, summarize

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("key", sorted(registry.QUERIES))
def test_no_forbidden_operators(spark, key):
    text = plan_text(entry.queries()[key](spark, SF))
    assert summarize(text)["bad"] == []


def test_projection_reaches_the_scan(spark):
    text = plan_text(entry.queries()["stg_health"](spark, SF))
    schema = [line for line in text.splitlines() if line.startswith("ReadSchema")]
    assert schema and all("c_name" not in s and "c_mktsegment" not in s for s in schema)


def test_dimension_join_follows_the_byte_limit(spark, scratch):
    """A written dimension of few bytes is broadcast; beyond Spark's byte limit the join shuffles."""
    from fleetlake.operators.joins import join_dimension
    from fleetlake.plans.pipeline import Layers
    layers = Layers.from_test_tables(spark, SF)
    layers.dim_device.write.parquet(f"{scratch}/dim")
    fact, dim = layers.stg("telemetry"), spark.read.parquet(f"{scratch}/dim")
    small = plan_text(join_dimension(fact, dim, "device_id")).split("\n\n")[0]
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        big = plan_text(join_dimension(fact, dim, "device_id")).split("\n\n")[0]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert "SortMergeJoin" in big and "BroadcastHashJoin" in small and "SortMergeJoin" not in small


def test_daily_aggregates_combine_before_the_shuffle(spark):
    text = plan_text(entry.queries()["calibration_daily"](spark, SF))
    tree = text.split("\n\n")[0]
    # partial HashAggregate below the exchange on (device_id, date), final above it
    assert tree.count("HashAggregate") >= 2
