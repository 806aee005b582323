"""Joins that stay balanced when a few keys own much of the data."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def lookup_join(left: DataFrame, right: DataFrame, on: list[str], share: float = 0.005, how: str = "left", hot: DataFrame | None = None) -> DataFrame:
    """left join (or inner join) right, where right has one row per key at most.

    Keys that own at least share of left's rows are looked up in a broadcast of their own rows of
    right: at most 1 / share rows, whatever the size of the data. Rows of left with a null in a key can
    find nothing: they go with those, beside the shuffle. The rest is a shuffle join. hot names such keys
    where they are known already, as many at most, so that left is not counted again.
    """
    hot = F.broadcast(_hot(left, on, share) if hot is None else hot.select(*on, F.lit(True).alias("hot_")))
    flagged = left.join(hot, on, "left")
    few = F.broadcast(right.join(hot.drop("hot_"), on, "left_semi"))
    unknown = reduce(Column.__or__, [F.col(c).isNull() for c in on])
    beside = F.col("hot_").isNotNull() | unknown
    rest = flagged.where(~beside).drop("hot_").join(right, on, how)
    return rest.unionByName(flagged.where(beside).drop("hot_").join(few, on, how))


def _hot(df: DataFrame, on: list[str], share: float) -> DataFrame:
    counts = df.dropna(subset=on).groupBy(*on).agg(F.count("*").alias("n_"))
    total = df.agg(F.count("*").alias("all_"))
    return counts.join(F.broadcast(total), F.col("n_") >= F.greatest(F.lit(2.0), F.col("all_") * share)).select(*on, F.lit(True).alias("hot_"))
