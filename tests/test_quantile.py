"""The distributed exact quantile equals Spark's exact ``percentile``."""

from pyspark.sql import functions as F

from fleetlake.operators.aggregates import telemetry_daily
from fleetlake.operators.quantile import exact_quantiles
from fleetlake.plans.pipeline import Layers

SF_SMALL = "/root/testdata/sf0.001"


def test_matches_percentile_on_random_groups(spark):
    df = spark.range(0, 20000).select((F.col("id") % 7).alias("g"),
                                      F.when(F.col("id") % 11 == 0, None)
                                      .otherwise(F.round(F.rand(42) * 100, 1)).alias("x"))
    qs = {"p01": 0.01, "p50": 0.5, "p99": 0.99, "p100": 1.0}
    got = {r["g"]: r for r in exact_quantiles(df, ["g"], "x", qs, partitions=5).collect()}
    want = {r["g"]: r for r in df.groupBy("g").agg(
        *[F.percentile("x", F.lit(q)).alias(n) for n, q in qs.items()]).collect()}
    assert got.keys() == want.keys()
    for g in want:
        for n in qs:
            assert got[g][n] == want[g][n], (g, n, got[g][n], want[g][n])


def test_telemetry_daily_strategies_agree(spark):
    fct = Layers.from_test_tables(spark, SF_SMALL).fct_telemetry
    a = sorted(map(tuple, telemetry_daily(fct, quantile_strategy="percentile").collect()))
    b = sorted(map(tuple, telemetry_daily(fct, quantile_strategy="distributed").collect()))
    assert a == b
