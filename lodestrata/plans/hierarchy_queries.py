"""Queries of problem 6: lineages of the models of hub and sheet."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.hierarchy import descendants, lineages
from ..session import table

HUB, SHEET = "source_huggingface_page1", "source_epoch"
_HUB_NAME = r"^[a-z0-9_.\-]+/[a-z0-9_.\-]+$"
# What a base says for "none".
NO_BASE = ("", "-", "--", "none", "null", "n/a", "na", "nan", "scratch", "unknown", "unspecified", "n.a.", "?", "tbd")


def hub_names(text: Column) -> Column:
    """Array of the owner/name pairs in text: without links, revisions, list marks and case."""
    low = F.lower(F.regexp_replace(text, r"\\[nrt]", " "))
    words = F.split(F.regexp_replace(low, r"[\s ​﻿\"'“”‘’`\[\],;<>()|]+", " "), " ")
    path = F.transform(words, lambda w: F.regexp_replace(F.regexp_replace(w, r"^(?:[a-z]+://)?(?:[a-z0-9\-]+\.)+[a-z]+/(?=[^/]+/[^/]+)|^[a-z]+://[^/]+/", ""), r"[@?#:].*$", ""))
    pair = F.transform(path, lambda p: F.regexp_extract(p, r"^/?([^/]+/[^/]+)", 1))
    return F.filter(pair, lambda p: p.rlike(_HUB_NAME) & ~p.isin(*NO_BASE))


def _hub_links(rows: DataFrame) -> DataFrame:
    named = F.concat(
        F.flatten(F.transform(F.coalesce("base_models", F.array().cast("array<string>")), lambda b: F.coalesce(hub_names(b), F.array().cast("array<string>")))),
        F.coalesce(hub_names(F.col("card_data.base_model")), F.array().cast("array<string>")),
    )
    votes = rows.select(F.col("id").alias("node"), F.explode(named).alias("parent")).groupBy("node", "parent").agg(F.count("*").alias("n"))
    return votes.groupBy("node").agg(F.min_by("parent", F.struct(-F.col("n"), "parent")).alias("parent")).select(F.lit(HUB).alias("tab"), "node", "parent")


def _plain(name: Column) -> Column:
    """A sheet's name without the marks and notes around it."""
    bare = F.regexp_replace(name, r"^[\s \"'“”‘’]+|[\s \"'“”‘’]+$", "")
    return F.regexp_replace(F.regexp_replace(bare, r"\s*[(\[][^()\[\]]*[)\]]\s*$", ""), r"[\s ]+", " ")


def _key(name: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(name), r"[^\p{L}\p{N}]+", " "))


def _sheet_links(rows: DataFrame) -> DataFrame:
    named = rows.where("model is not null and base_model is not null").select(
        F.col("model").alias("node"), _plain(F.col("base_model")).alias("base"), _key(F.col("base_model")).alias("whole"), _key(_plain(F.col("base_model"))).alias("key")
    )
    named = named.where(~F.lower("base").isin(*NO_BASE) & (F.col("key") != ""))
    votes = named.groupBy("node", "whole", "key", "base").agg(F.count("*").alias("n"))
    models = rows.where("model is not null").groupBy("model").agg(F.count("*").alias("n")).groupBy(_key(F.col("model")).alias("key"))
    spelled = models.agg(F.min_by("model", F.struct(-F.col("n"), "model")).alias("spelling"))
    # A base without a row takes its most common spelling.
    written = votes.groupBy("key", "base").agg(F.sum("n").alias("n")).groupBy("key").agg(F.min_by("base", F.struct(-F.col("n"), "base")).alias("common"))
    found = votes.join(spelled.withColumnsRenamed({"key": "whole", "spelling": "exact"}), "whole", "left").join(spelled, "key", "left").join(written, "key", "left")
    parents = found.groupBy("node", F.coalesce("exact", "spelling", "common").alias("parent")).agg(F.sum("n").alias("n"))
    return parents.groupBy("node").agg(F.min_by("parent", F.struct(-F.col("n"), "parent")).alias("parent")).select(F.lit(SHEET).alias("tab"), "node", "parent")


def _all(spark: SparkSession, folder: str) -> DataFrame:
    hub, sheet = table(spark, folder, HUB), table(spark, folder, SHEET)
    nodes = hub.select(F.lit(HUB).alias("tab"), F.col("id").alias("node")).unionByName(sheet.select(F.lit(SHEET).alias("tab"), F.col("model").alias("node")))
    return lineages(nodes, _hub_links(hub).unionByName(_sheet_links(sheet)))


def p6_found(spark: SparkSession, folder: str) -> DataFrame:
    return _all(spark, folder)


def p6_descendants(spark: SparkSession, folder: str) -> DataFrame:
    return descendants(_all(spark, folder))


QUERIES = {"p6_found": p6_found, "p6_descendants": p6_descendants}
ORACLES: dict[str, str] = {}
