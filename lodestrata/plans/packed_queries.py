"""Queries of problem 1: the values packed in cells of the sheet."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..operators.packed_fields import split_packed
from ..session import table

FIELDS = ("archived_links", "task", "domain", "organization")


def p1_found(spark: SparkSession, folder: str) -> DataFrame:
    return split_packed(table(spark, folder, "source_epoch"), "epoch_row", FIELDS, table(spark, folder, "reference_values"), ("archived_links",))


QUERIES = {"p1_found": p1_found}
ORACLES: dict[str, str] = {}
