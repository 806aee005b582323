"""Fail-closed checks: a violation is a row, and a result that has any is refused."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class Violation(ValueError):
    """Invalid input; the message names the condition and a few offending rows."""


def assert_empty(violations: DataFrame, what: str) -> None:
    rows = violations.limit(3).collect()
    if rows:
        raise Violation(f"{what}: {', '.join(str(r.asDict()) for r in rows)}")


def orphans(child: DataFrame, parent: DataFrame, on: list[str]) -> DataFrame:
    """Rows of child without a parent."""
    return child.join(parent.select(*on).distinct(), on, "left_anti")


def duplicates(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")


def contradictions(df: DataFrame, keys: list[str], content: Column) -> DataFrame:
    """Keys whose rows differ in content; identical duplicates are none."""
    return df.groupBy(*keys).agg(F.count_distinct(content).alias("n")).where("n > 1")


def flagged(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """Rows that break a rule, with issue, the first rule broken; a rule that is null is broken."""
    issue = reduce(lambda acc, item: acc.when(~F.coalesce(item[1], F.lit(False)), item[0]), rules.items(), F.when(F.lit(False), ""))
    return df.withColumn("issue", issue).where(F.col("issue").isNotNull())
