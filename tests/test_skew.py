from pyspark.sql import functions as F

from lodestrata.operators.skew import lookup_join


def both(spark):
    left = spark.range(9000).select("id", F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 3 == 1, F.concat(F.lit("k"), (F.col("id") % 500).cast("string"))).alias("key"))
    right = spark.createDataFrame([("hot", 1), *[(f"k{n}", n) for n in range(0, 500, 2)]], "key string, value long")
    return left, right


def test_hot_and_null_keys(spark):
    left, right = both(spark)
    for how in ("left", "inner"):
        expected = sorted(left.join(right, "key", how).select("id", "value").collect())
        assert sorted(lookup_join(left, right, ["key"], how=how).select("id", "value").collect()) == expected
        known = lookup_join(left, right, ["key"], how=how, hot=spark.createDataFrame([("hot",)], "key string"))
        assert sorted(known.select("id", "value").collect()) == expected


def test_null_keys_stay_in_their_partitions(spark):
    left, right = both(spark)
    joined = lookup_join(left.repartition(8).where("key is null"), right, ["key"])
    sizes = [r["n"] for r in joined.groupBy(F.spark_partition_id().alias("p")).agg(F.count("*").alias("n")).collect()]
    assert sum(sizes) == 3000 and max(sizes) < 1000


def test_several_keys_and_nothing(spark):
    left = spark.createDataFrame([(1, "a"), (1, None), (None, "a"), (2, "b")], "x int, y string")
    right = spark.createDataFrame([(1, "a", 7)], "x int, y string, v int")
    assert sorted(lookup_join(left, right, ["x", "y"]).select("v").collect(), key=str) == [(7,), (None,), (None,), (None,)]
    assert lookup_join(left, right, ["x", "y"], how="inner").count() == 1
    assert lookup_join(left.limit(0), right, ["x", "y"]).count() == lookup_join(left.limit(0), right.limit(0), ["x", "y"]).count() == 0
