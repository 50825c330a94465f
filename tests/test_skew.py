"""A key holding a third of all rows: the validator's joins are split.

Violating keys are found by an aggregation that combines before its shuffle
(one row per key and map partition).  The join of the rows to them is a
broadcast when the staged keys are few; when they are not (broadcasts are off
here), the rows of a hot key are dealt over salts.
"""

import contextlib

from pyspark.sql import functions as F

from corral.functions import rules as R
from corral.operators import quality as Q


@contextlib.contextmanager
def conf(spark, **kv):
    old = {k: spark.conf.get(k, None) for k in kv}
    for k, v in kv.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


SKEW = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
    "spark.sql.shuffle.partitions": "8",
}


def skewed(spark, n=30000):
    # key 7 holds a third of the rows
    return spark.range(n, numPartitions=8).select(
        F.col("id"),
        F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id")).alias("k"),
        (F.col("id") * 1.5).alias("v"),
    )


def final_plan(df) -> str:
    """Run ``df`` and return its final adaptive plan."""
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().partition("== Initial Plan ==")[0]


def rows_per_task(df) -> list[int]:
    return [r["n"] for r in df.groupBy(F.spark_partition_id().alias("p")).agg(F.count(F.lit(1)).alias("n")).collect()]


NO_BROADCAST = SKEW | {"spark.sql.adaptive.skewJoin.enabled": "false"}


def test_unique_on_hot_key_is_split_and_exact(spark):
    with conf(spark, **NO_BROADCAST):
        df = skewed(spark)
        v = Q.validate(df, [R.unique("k", action="quarantine")])
        bad = v.erroneous_data
        plan = final_plan(bad)
        assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan, plan
        dup_keys = [r["k"] for r in df.groupBy("k").count().where("count > 1").collect()]
        assert dup_keys == [7]
        assert bad.count() == df.where(F.col("k") == 7).count() == 10001
        assert v.correct_data.count() == 30000 - 10001
        # without any help from AQE the hot key's rows are in every task of the join
        sizes = rows_per_task(bad)
        assert len(sizes) == 8 and max(sizes) < 2 * 10001 / 8, sizes


def test_two_rules_on_one_hot_column_share_a_split_join(spark):
    with conf(spark, **NO_BROADCAST):
        df = skewed(spark).withColumn("k", F.when(F.col("id") == 5, F.lit(None)).otherwise(F.col("k")))
        odd = spark.range(9, 30000, 2).select(F.col("id").alias("pk"))
        third = spark.range(0, 30000, 3).select(F.col("id").alias("pk"))
        rules = [
            R.foreign_key("k", odd, "pk", action="failjob"),
            R.foreign_key("k", third, "pk", action="quarantine"),
            R.unique("k", action="report"),
        ]
        v = Q.validate(df, rules)
        assert final_plan(v.tagged).count("Join") == 1
        counts = [r["Impacted_Records"] for r in v.summary.collect()]
        k = F.col("k")
        expected = [
            df.where((k < 9) | (k % 2 == 0)).count(),
            df.where(k % 3 != 0).count(),
            df.where(k == 7).count(),
        ]
        assert counts == expected
        assert v.correct_data.count() == df.where(k.isNull() | ((k >= 9) & (k % 6 == 3))).count()
        assert max(rows_per_task(v.erroneous_data)) < 2 * v.erroneous_data.count() / 8


def test_few_violations_shuffle_no_full_width_row(spark):
    df = skewed(spark).withColumn("k", F.when(F.col("k") == 7, F.col("id")).otherwise(F.col("k"))).withColumn("wide", F.lit("x" * 50))
    df = df.union(df.where("id in (11, 12)")).union(df.where("id = 13").withColumn("k", F.lit(-1)))
    parent = spark.range(30000).select(F.col("id").alias("pk"))
    v = Q.validate(df, [R.unique("k"), R.foreign_key("k", parent, "pk")])
    plan = final_plan(v.erroneous_data)
    assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan, plan
    assert sorted(r["k"] for r in v.erroneous_data.collect()) == [-1, 11, 11, 12, 12]
    clean = Q.validate(skewed(spark), [R.foreign_key("k", parent, "pk"), R.unique("id")])
    assert "Join" not in final_plan(clean.erroneous_data) and clean.correct_data.count() == 30000


def test_duplicate_rows(spark):
    from corral.operators.key_sets import duplicate_rows

    df = spark.createDataFrame([(1, "a"), (1, "a"), (None, "b"), (None, "b"), (2, "c"), (None, None)], "k int, v string")
    got = sorted((tuple(r) for r in duplicate_rows(df, ["k", "v"]).collect()), key=repr)
    assert got == sorted([(1, "a", 2), (1, "a", 2), (None, "b", 2), (None, "b", 2)], key=repr)
    assert duplicate_rows(df.limit(1), ["k"]).collect() == []
