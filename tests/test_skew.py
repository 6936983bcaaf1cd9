"""Joining summaries back to rows: results with hot and null keys, split plan."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from acctflow.operators.skew import join_by_key


def _rows(spark):
    key = F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 3 == 1, F.lit(None)).otherwise(
        F.concat(F.lit("k"), (F.col("id") % 50).cast("string"))
    )
    return spark.range(0, 3000).select(key.alias("k"), "id")


def test_join_by_key_equals_plain_join(spark):
    rows = _rows(spark)
    per_key = rows.groupBy("k").agg(F.sum("id").alias("total"))
    plain = rows.join(per_key, "k", "left").select("k", "id", "total")
    out = join_by_key(rows, per_key, ["k"])
    assert out.columns == ["k", "id", "total"]
    assert sorted(map(tuple, out.collect()), key=str) == sorted(map(tuple, plain.collect()), key=str)
    assert join_by_key(rows, per_key, ["k"], "inner").count() == 2000
    with pytest.raises(ValueError):
        join_by_key(rows, per_key, ["k"], "full")


def test_hot_key_is_split_and_nulls_spread(spark):
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "4k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.1", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4k",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    before = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        rows = spark.range(0, 60000, 1, 8).select(F.when(F.col("id") % 2 == 0, 7).otherwise(F.col("id")).alias("k"), "id")
        out = join_by_key(rows, rows.groupBy("k").agg(F.max("id").alias("m")), ["k"])
        out.collect()
        assert "skew=true" in out._jdf.queryExecution().executedPlan().toString()
        nulls = spark.range(0, 8000, 1, 8).select(F.lit(None).cast("long").alias("k"), "id")
        spread = join_by_key(nulls, rows.groupBy("k").agg(F.max("id").alias("m")), ["k"])
        sizes = [r["count"] for r in spread.groupBy(F.spark_partition_id()).count().collect()]
        assert sum(sizes) == 8000 and max(sizes) < 2500
    finally:
        for k, v in before.items():
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)
